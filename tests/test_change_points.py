from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from stockflow.operators import daily
from stockflow.plans import change_points, marts, reports
from tests.rows import D0, day, moves, sales


def same(got, want):
    assert got.dtypes == want.dtypes
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def random_rows(seed, days, several):
    dice = random.Random(seed)

    def category(sku):
        return dice.choice(["Tops", "Denim", None]) if several and sku in "AB" else "TD"[ord(sku) % 2]

    sold = []
    for _ in range(60):
        sku = dice.choice("ABCDE")
        sold.append({"d": dice.randint(-3, days + 3), "sku": sku, "category": category(sku), "quantity": dice.randint(1, 9),
                     "unit_price": Decimal(dice.randint(1, 9999)) / 100, "discount_pct": Decimal(dice.randint(0, 30))})
    moved = []
    for _ in range(40):
        sku = dice.choice("ABCDEF")
        moved.append({"d": dice.randint(-3, days + 3), "sku": sku, "category": category(sku), "delta": dice.choice([-20, 5, 60])})
    return sold, moved


@pytest.mark.parametrize("seed, days, several", [(1, 90, False), (2, 90, True), (3, 4, True), (4, 40, False), (5, 0, True)])
def test_equals_the_dense_summary(spark, seed, days, several):
    sold, moved = random_rows(seed, days, several)
    s, m = sales(spark, *sold).cache(), moves(spark, *moved).cache()
    want = reports.category_daily_summary(marts.inventory_snapshot(s, m, D0, day(days)))
    same(change_points.category_daily_summary(s, m, D0, day(days)), want)


def test_rows_grow_with_activity_and_not_with_the_calendar(spark):
    s = sales(spark, {"d": 100, "quantity": 2}, {"d": 103})
    m = moves(spark, {"d": 90, "delta": 50}, {"sku": "B", "d": 95, "delta": 1})
    long = D0 + dt.timedelta(days=20_000)
    found = change_points.change_points(daily.daily_activity(s, m, D0, long), D0, long)
    by_sku = {}
    for r in found.collect():
        by_sku.setdefault(r.sku, []).append(r.n)
    assert sorted(by_sku["A"]) == [0, 90, 100, 103, 107, 110, 130, 133]
    assert sorted(by_sku["B"]) == [0, 95]


def test_frames_that_grow_change_each_day(spark):
    s, m = sales(spark, {"d": 27, "quantity": 2}), moves(spark, {"d": 0, "delta": 9})
    found = change_points.change_points(daily.daily_activity(s, m, D0, day(60)), D0, day(60))
    assert sorted(r.n for r in found.collect()) == [0, 27, 28, 29, 34, 57]


def test_empty_tables_give_no_rows(spark):
    s, m = sales(spark, {}).filter("false"), moves(spark, {}).filter("false")
    assert change_points.category_daily_summary(s, m, D0, day(9)).isEmpty()


def test_staging_is_read_once(spark, tmp_path):
    sales(spark, {"d": 1}).write.parquet(f"{tmp_path}/s")
    moves(spark, {"d": 1}).write.parquet(f"{tmp_path}/m")
    s, m = spark.read.parquet(f"{tmp_path}/s"), spark.read.parquet(f"{tmp_path}/m")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = change_points.category_daily_summary(s, m, D0, day(9))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "ReusedExchange" in plan and plan.count("FileScan") == 2
