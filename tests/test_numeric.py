"""Hand-computed cases for the expression helpers, so a shared formula cannot hide an error."""

from __future__ import annotations

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction
import random

import pytest

from stockflow.functions import numeric as N
from stockflow.functions import scalars as S


def one(spark, expr):
    return spark.sql(f"SELECT {expr} AS x").first()["x"]


@pytest.mark.parametrize(
    ("num", "den", "digits", "want"),
    [
        (11, 30, 2, "0.37"),
        (7, 2, 2, "3.50"),
        (1, 8, 2, "0.13"),
        (-1, 8, 2, "-0.13"),
        (-3, 2, 1, "-1.5"),
        (1, 3, 1, "0.3"),
        (200, 3, 1, "66.7"),
        (0, 5, 2, "0.00"),
    ],
)
def test_ratio(spark, num, den, digits, want):
    assert one(spark, N.ratio_round(f"{num}L", f"{den}L", digits)) == Decimal(want)


def test_ratio_without_denominator(spark):
    assert one(spark, N.ratio_round("1L", "0L", 2)) is None
    assert one(spark, N.ratio_round("1L", "cast(NULL AS bigint)", 2)) is None
    assert one(spark, N.ratio_round("cast(NULL AS bigint)", "3L", 2)) is None


def test_ratio_matches_exact_fractions(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(-(10**6), 10**6), rng.randrange(1, 2000)) for _ in range(500)]
    pairs += [(n, 16) for n in range(-40, 41)]
    df = spark.createDataFrame(pairs, "n bigint, d bigint")
    for digits in (1, 2):
        for r in df.selectExpr("n", "d", f"{N.ratio_round('n', 'd', digits)} AS x").collect():
            exact = Fraction(abs(r.n) * 10**digits, r.d)
            whole = int(exact + Fraction(1, 2)) * (-1 if r.n < 0 else 1)
            assert r.x == Decimal(whole).scaleb(-digits), r


def test_money_ratio_beyond_bigint(spark):
    big = "cast(9000000000000000.01 AS decimal(18,2))"
    got = one(spark, N.ratio_round(N.wide(N.cents(big)), N.wide("300"), 2))
    want = (Decimal("9000000000000000.01") / 3).quantize(Decimal("0.01"), ROUND_HALF_UP)
    assert got == want


def test_mean_just_below_a_half(spark):
    df = spark.range(20001).selectExpr("cast(if(id < 10000, 0.01, 0.00) AS decimal(5,2)) AS d")
    got = df.selectExpr("count(1)").count() and df.agg(*S.exprs(f"{N.mean_round('d')} AS m"))
    assert got.first()["m"] == Decimal("0.00")


@pytest.mark.parametrize(
    ("stock", "units", "days", "reorder", "overstock", "cover"),
    [
        (7, 10, 30, False, False, "21.0"),
        (524, 750, 30, True, False, "21.0"),
        (30, 10, 30, False, False, "90.0"),
        (31, 10, 30, False, True, "93.0"),
        (5, 0, 30, False, False, None),
    ],
)
def test_cover(spark, stock, units, days, reorder, overstock, cover):
    args = (f"{stock}L", f"{units}L", f"{days}L")
    assert one(spark, N.cover_below(*args, 21)) is reorder
    assert one(spark, N.cover_above(*args, 90)) is overstock
    assert one(spark, S.days_on_hand(*args)) == (cover and Decimal(cover))


def test_tiers(spark):
    want = {
        (0, None): "OUT_OF_STOCK", (1, "6.9"): "CRITICAL", (1, "7.0"): "WARNING",
        (1, "13.9"): "WARNING", (1, "14.0"): "LOW", (1, "20.9"): "LOW", (1, "21.0"): "HEALTHY",
        (5, None): "HEALTHY",
    }
    for (stock, days), tier in want.items():
        cover = "cast(NULL AS decimal(18,1))" if days is None else f"{days}BD"
        assert one(spark, S.urgency_tier(f"{stock}L", cover)) == tier


@pytest.mark.parametrize(
    ("velocity", "stock", "want"), [("0.33", 2, 8), ("0.33", 50, 0), ("0.37", 0, 12)]
)
def test_reorder_quantity(spark, velocity, stock, want):
    v = f"cast({velocity} AS decimal(18,2))"
    assert one(spark, S.reorder_quantity(v, f"{stock}L")) == want


def test_calendar(spark):
    assert one(spark, S.week_start("DATE '2024-12-29'")) == dt.date(2024, 12, 23)
    assert one(spark, S.month_start("DATE '2024-12-29'")) == dt.date(2024, 12, 1)


def test_text_keeps_tabs(spark):
    assert one(spark, S.upper_clean("' tops '")) == "TOPS"
    assert one(spark, S.upper_clean("'\ttops'")) == "\tTOPS"


def test_direction(spark):
    assert [one(spark, S.direction(f"({d})")) for d in (3, -3, 0)] == ["inbound", "outbound", "neutral"]
