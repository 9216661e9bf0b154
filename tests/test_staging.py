from __future__ import annotations

import datetime as dt
import decimal
from decimal import Decimal

import pytest

from stockflow.operators import dedup, staging, upsert
from tests.rows import T0, listed, raw_moves, raw_sales


def test_sales_guards(spark):
    raw = raw_sales(
        spark, {}, {"event_id": None}, {"sku": None}, {"quantity": 0}, {"quantity": None},
        {"unit_price": Decimal("0.00")}, {"unit_price": None}, {"quantity": -1},
    )
    assert listed(staging.stg_sales(raw), "event_id") == [("s0",)]


def test_unknown_discount_keeps_net_unknown(spark):
    got = staging.stg_sales(raw_sales(spark, {"quantity": 2, "discount_pct": None})).first()
    assert (got.discount_pct, got.gross_revenue, got.net_revenue) == (
        Decimal("0.00"), Decimal("20.00"), None,
    )


def test_net_rounds_half_up(spark):
    raw = raw_sales(spark, {"unit_price": Decimal("0.10"), "discount_pct": Decimal("5.00")})
    assert staging.stg_sales(raw).first().net_revenue == Decimal("0.10")


def test_iso_week_with_calendar_year(spark):
    got = staging.stg_sales(raw_sales(spark, {"ts": dt.datetime(2024, 12, 30, 8)})).first()
    assert (got.event_week, got.event_month, got.event_year) == (1, 12, 2024)
    assert got.event_date == dt.date(2024, 12, 30)


def test_business_zone_moves_the_day(spark):
    raw = raw_sales(spark, {"ts": dt.datetime(2024, 3, 4, 20)})
    assert staging.stg_sales(raw).first().event_date == dt.date(2024, 3, 4)
    assert staging.stg_sales(raw, "Asia/Kolkata").first().event_date == dt.date(2024, 3, 5)


def test_movements(spark):
    raw = raw_moves(spark, {"delta": 5, "warehouse": " wh-x "}, {"delta": -3}, {"delta": 0}, {"delta": None})
    got = staging.stg_stock_movements(raw)
    assert listed(got, "stock_delta", "direction", "units_moved", "warehouse") == [
        (-3, "outbound", 3, "WH-WEST"), (5, "inbound", 5, "WH-X"),
    ]


def test_first_arrival_wins(spark):
    raw = raw_sales(
        spark,
        {"event_id": "e1", "unit_price": Decimal("12.00"), "ingested_at": T0 + dt.timedelta(hours=1)},
        {"event_id": "e1", "unit_price": Decimal("10.00")},
    )
    assert listed(dedup.first_wins(raw, "event_id", ["ingested_at"]), "unit_price") == [(Decimal("10.00"),)]


def test_first_arrival_is_cut_down_before_the_shuffle(spark):
    plan = dedup.first_wins(raw_sales(spark, {}), "event_id", ["ingested_at"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def test_unseen(spark):
    batch, target = raw_sales(spark, {"event_id": "a"}, {"event_id": "b"}), raw_sales(spark, {"event_id": "a"})
    assert listed(dedup.unseen(batch, target, "event_id"), "event_id") == [("b",)]


def test_high_water_mark_and_slice(spark):
    raw = raw_sales(spark, {}, {"ingested_at": T0 + dt.timedelta(seconds=1, microseconds=7)})
    mark = staging.high_water_mark(raw)
    assert mark == (T0 + dt.timedelta(seconds=1, microseconds=7)).replace(tzinfo=dt.timezone.utc)
    assert staging.high_water_mark(raw.limit(0)) is None
    assert staging.newer_than(raw, None).count() == 2
    assert staging.newer_than(raw, mark).count() == 0
    assert staging.newer_than(raw, mark, dt.timedelta(microseconds=1)).count() == 1
    assert staging.newer_than(raw, T0).count() == 1


def test_upsert_newer_wins(spark):
    old = raw_sales(spark, {"event_id": "e1"}, {"event_id": "e2"})
    new = raw_sales(spark, {"event_id": "e1", "quantity": 9})
    assert listed(upsert.upsert(old, new, "event_id"), "event_id", "quantity") == [("e1", 9), ("e2", 1)]


def test_sync_columns(spark):
    old = spark.createDataFrame([("a", 1)], "event_id string, gone int")
    new = spark.createDataFrame([("b", 2)], "event_id string, added int")
    assert listed(upsert.upsert(old, new), "event_id", "added") == [("a", None), ("b", 2)]


def test_amounts_out_of_range_are_set_aside_and_surcharges_are_exact(spark):
    D = decimal.Decimal
    raw = raw_sales(
        spark,
        {"event_id": "surcharge", "quantity": 2, "unit_price": D("10.00"), "discount_pct": D("-950.00")},
        {"event_id": "huge", "quantity": 2_000_000_000, "unit_price": D("9999999999.99")},
    )
    got = staging.stg_sales(raw).select("event_id", "gross_revenue", "net_revenue").collect()
    assert [tuple(r) for r in got] == [("surcharge", D("20.00"), D("210.00"))]
    assert listed(staging.oversized_sales(raw), "event_id", "reason") == [("huge", "amount out of range")]
