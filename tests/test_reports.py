from __future__ import annotations

import datetime as dt
import itertools
from decimal import Decimal

import pytest

from stockflow.plans import reports
from tests.rows import D0, day, listed, raw_deliveries, sales

SNAPSHOT = (
    "snapshot_date date, sku string, category string, stock_on_hand bigint, units_sold bigint, "
    "gross_revenue decimal(18,2), net_revenue decimal(18,2), velocity_7d decimal(18,2), "
    "velocity_30d decimal(18,2), days_on_hand decimal(18,1), is_reorder_required boolean, "
    "is_overstock boolean"
)


def snapshot(spark, *rows):
    zero = Decimal("0.00")
    base = dict(
        snapshot_date=D0, sku="A", category="T", stock_on_hand=5, units_sold=1, gross_revenue=zero,
        net_revenue=zero, velocity_7d=zero, velocity_30d=zero, days_on_hand=None,
        is_reorder_required=False, is_overstock=False,
    )
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], SNAPSHOT)


def test_flag_counts_are_null_without_flags(spark):
    got = reports.category_daily_summary(snapshot(spark, {}, {"sku": "B", "is_overstock": True})).first()
    assert (got.reorder_skus, got.overstock_skus, got.active_skus) == (None, 1, 2)
    assert got.avg_discount_pct is None and got.avg_days_on_hand is None


def test_mean_of_days_is_not_rounded(spark):
    rows = [{"sku": s, "days_on_hand": Decimal(d)} for s, d in (("A", "1.0"), ("B", "1.0"), ("C", "2.0"))]
    got = reports.category_daily_summary(snapshot(spark, *rows)).first()
    assert got.avg_days_on_hand == 4.0 / 3


def test_effective_discount(spark):
    row = {"gross_revenue": Decimal("300.00"), "net_revenue": Decimal("200.00")}
    assert reports.category_daily_summary(snapshot(spark, row)).first().avg_discount_pct == Decimal("33.33")


def test_flagged_and_still_healthy(spark):
    row = {"days_on_hand": Decimal("21.0"), "is_reorder_required": True}
    got = reports.reorder_watchlist(snapshot(spark, row), D0).first()
    assert (got.is_reorder_required, got.stock_status) == (True, "HEALTHY")


def test_watchlist_is_the_day_only_and_one_row_per_sku(spark):
    snap = snapshot(spark, {"category": "B"}, {"category": "A"}, {"snapshot_date": day(1)})
    assert listed(reports.reorder_watchlist(snap, D0), "sku", "category") == [("A", "A")]
    assert reports.reorder_watchlist(snap, day(9)).count() == 0


def test_unknown_cover_is_shown_first(spark):
    rows = [{"sku": s, "days_on_hand": d and Decimal(d)} for s, d in (("A", "3.0"), ("B", None), ("C", "1.0"))]
    watch = reports.reorder_watchlist(snapshot(spark, *rows), D0)
    shown = reports.shown("mv_sku_reorder_watchlist", watch).collect()
    assert [r.days_on_hand for r in shown] == [None, Decimal("1.0"), Decimal("3.0")]


def test_channel_week(spark):
    s = sales(
        spark,
        {"transaction_id": "t", "quantity": 3, "discount_pct": Decimal("10.00")},
        {"transaction_id": "t", "sku": "B"},
        {"transaction_id": "u", "sku": "B", "d": 6, "discount_pct": None},
    )
    got = reports.channel_revenue_weekly(s).collect()
    assert len(got) == 1
    r = got[0]
    assert (r.active_skus, r.units_sold, r.transactions) == (2, 5, 2)
    assert (r.gross_revenue, r.net_revenue) == (Decimal("50.00"), Decimal("37.00"))
    assert (r.avg_discount_pct, r.avg_basket_value) == (Decimal("3.33"), Decimal("18.50"))


def test_supplier(spark):
    rows = [{"actual_date": d} for d in (day(-1), day(0), day(2), None)]
    got = reports.supplier_performance(raw_deliveries(spark, *rows)).collect()
    assert [(r.total_deliveries, r.on_time_pct, r.avg_lead_variance_days, r.total_cost) for r in got] == [
        (3, Decimal("66.7"), Decimal("0.3"), Decimal("60.00"))
    ]


def test_early_supplier(spark):
    got = reports.supplier_performance(raw_deliveries(spark, {"actual_date": day(-1)}, {"actual_date": day(-2)}))
    assert got.first().avg_lead_variance_days == Decimal("-1.5")


def test_undelivered_supplier_has_no_row(spark):
    assert reports.supplier_performance(raw_deliveries(spark, {"actual_date": None})).count() == 0


def test_kpis(spark):
    rows = [
        {"sku": "A", "stock_on_hand": 0},
        {"sku": "B", "stock_on_hand": 4, "days_on_hand": Decimal("6.5")},
        {"sku": "C", "stock_on_hand": 9, "days_on_hand": Decimal("30.0")},
    ]
    watch = reports.reorder_watchlist(snapshot(spark, *rows), D0)
    s = sales(spark, {"quantity": 2}, {"d": 1, "quantity": 50})
    assert tuple(reports.daily_kpis(watch, s, D0).first()) == (
        D0, 13, 3, 2, Decimal("18.3"), Decimal("20.00"), 2, Decimal("66.7"),
    )


def _ascending(value, descending, nulls_first):
    """Sort key of one column, the number of a date or amount turned round where it descends."""
    if value is None:
        return (not nulls_first, 0)
    number = value.toordinal() if isinstance(value, dt.date) else value
    return (nulls_first, -number if descending else number)


@pytest.mark.parametrize("name", reports.SHOWN_BY)
def test_reading_order(spark, name):
    """Every report by its two columns, unknown values where the order puts them."""
    terms = [term.split() for term in reports.SHOWN_BY[name].split(", ")]
    columns = [t[0] for t in terms]
    kinds = {c: "date" if c in ("week_start", "snapshot_date", "month") else "decimal(18,2)" for c in columns}
    values = {"date": [day(3), None, day(0), day(9)], "decimal(18,2)": [Decimal("7.50"), Decimal("-2.00"), None, Decimal("30.00")]}
    rows = list(itertools.product(*[values[kinds[c]] for c in columns]))
    df = spark.createDataFrame(rows, ", ".join(f"{c} {k}" for c, k in kinds.items()))
    got = [tuple(r) for r in reports.shown(name, df.repartition(4)).collect()]
    keys = [(t[1] == "DESC", t[-1] == "FIRST") for t in terms]
    assert got == sorted(rows, key=lambda r: [_ascending(v, *k) for v, k in zip(r, keys)])
