from __future__ import annotations

import random
from decimal import Decimal

from pyspark.sql import functions as F

from stockflow.operators import daily, quality, windows
from stockflow.plans import marts, reports
from tests.rows import D0, day, listed, moves, sales


def series(spark, s, m, days, column):
    snap = marts.inventory_snapshot(sales(spark, *s), moves(spark, *m), D0, day(days - 1))
    return [r[0] for r in snap.orderBy("sku", "snapshot_date").select(column).collect()]


def test_running_stock_floors_only_the_output(spark):
    got = series(spark, [{"d": 1, "quantity": 8}], [{"d": 0, "delta": 5}, {"d": 2, "delta": 10}], 3, "stock_on_hand")
    assert got == [5, 0, 7]


def test_first_days_average_over_fewer_rows(spark):
    got = series(spark, [{"d": 0, "quantity": 7}], [], 2, "velocity_7d")
    assert got == [Decimal("7.00"), Decimal("3.50")]


def test_activity_before_the_start_is_ignored(spark):
    got = series(spark, [], [{"d": -1, "delta": 100}, {"d": 1, "delta": 1}], 2, "stock_on_hand")
    assert got == [0, 1]


def test_sku_known_only_outside_the_window_is_listed(spark):
    assert series(spark, [{"d": -5, "sku": "Z"}], [], 3, "sku") == ["Z"] * 3


def test_two_categories_fan_out_and_are_reported(spark):
    s = sales(
        spark, {"category": "A", "quantity": 3}, {"category": "B", "quantity": 4},
    )
    snap = marts.inventory_snapshot(s, moves(spark), D0, D0)
    assert listed(snap, "category", "units_sold") == [("A", 3), ("A", 4), ("B", 3), ("B", 4)]
    report = quality.uniqueness_report(snap, ["snapshot_date", "sku"])
    assert listed(report, "sku", "row_count") == [("A", 4)]


def random_feeds(spark, seed, categories=("A", "B", None)):
    rng = random.Random(seed)

    def row(**more):
        return {"d": rng.randrange(-3, 45), "sku": rng.choice("PQRS"), "category": rng.choice(categories), **more}

    s = [row(quantity=rng.randrange(1, 9), discount_pct=rng.choice([None, Decimal("5.00")])) for _ in range(70)]
    m = [row(delta=rng.choice([-7, 3, 20])) for _ in range(40)]
    return sales(spark, *s), moves(spark, *m)


def test_dense_series_equals_the_joins(spark):
    for seed, start, end in ((1, 0, 40), (2, 5, 6), (3, 10, 10)):
        s, m = random_feeds(spark, seed)
        spine = daily.sku_date_spine(daily.sku_dimension(s, m), day(start), day(end))
        joined = daily.join_activity(spine, daily.daily_movements(m), daily.daily_sales_outflow(s))
        dense = daily.dense_activity(s, m, day(start), day(end))
        assert dense.exceptAll(joined).count() == 0 and joined.exceptAll(dense).count() == 0


def test_given_sku_list_replaces_the_derived_one(spark):
    s, m = random_feeds(spark, 4)
    skus = spark.createDataFrame([("P", "A"), ("NEW", "X")], "sku string, category string")
    spine = daily.sku_date_spine(skus, D0, day(20))
    joined = daily.join_activity(spine, daily.daily_movements(m), daily.daily_sales_outflow(s))
    dense = daily.dense_activity(s, m, D0, day(20), skus)
    assert dense.exceptAll(joined).count() == 0 and joined.exceptAll(dense).count() == 0


def test_frames_equal_sliding_windows(spark):
    s, m = random_feeds(spark, 5, categories=("A",))
    got = windows.with_running_stock(daily.dense_activity(s, m, D0, day(60)))
    over = "OVER (PARTITION BY sku ORDER BY snapshot_date ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"
    wrong = got.selectExpr(
        "*",
        *[f"sum(units_sold) {over.format(n - 1)} AS s{n}" for n in (7, 30)],
        *[f"count(1) {over.format(n - 1)} AS n{n}" for n in (7, 30)],
    ).filter("units_7d <> s7 OR units_30d <> s30 OR rows_7d <> n7 OR rows_30d <> n30")
    assert got.count() == 4 * 61 and wrong.count() == 0


def test_snapshot_invariants(spark):
    s, m = random_feeds(spark, 6, categories=("A",))
    snap = marts.inventory_snapshot(s, m, D0, day(44))
    assert snap.count() == 4 * 45
    assert quality.uniqueness_report(snap, ["snapshot_date", "sku"]).count() == 0
    assert snap.filter("is_reorder_required AND is_overstock OR gross_revenue < net_revenue").count() == 0
    last = windows.with_running_stock(daily.dense_activity(s, m, D0, day(44))).filter(
        F.col("snapshot_date") == day(44)
    )
    inside = F.col("event_date").between(D0, day(44))
    total = m.filter(inside).agg(F.sum("stock_delta")).first()[0] - s.filter(inside).agg(F.sum("quantity")).first()[0]
    assert last.agg(F.sum("running_stock")).first()[0] == total


def test_one_day_equals_the_snapshots_day(spark):
    """Also for SKUs under several categories, and where the calendar is shorter than the frames."""
    for seed, last in ((5, 44), (6, 29), (7, 12)):
        s, m = random_feeds(spark, seed)
        whole = marts.inventory_snapshot(s, m, D0, day(last)).filter(F.col("snapshot_date") == day(last))
        at = marts.inventory_at(s, m, D0, day(last))
        assert at.columns == whole.columns
        assert sorted(map(str, at.collect())) == sorted(map(str, whole.collect()))
        assert whole.count()


def test_snapshot_shuffles_twice(spark):
    s, m = random_feeds(spark, 7)
    plan = marts.inventory_snapshot(s, m, D0, day(9))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan


def weekly(spark, *rows):
    return marts.weekly_sales(sales(spark, *rows))


def test_change_is_against_the_previous_existing_week(spark):
    got = windows.with_weekly_change(weekly(spark, {"d": 0, "quantity": 10}, {"d": 14, "quantity": 4}))
    assert listed(got, "units_sold", "wow_units_delta", "wow_revenue_delta") == [
        (10, None, None), (4, -6, Decimal("-60.00")),
    ]


def test_opening_and_closing(spark):
    snap = spark.createDataFrame(
        [(day(1), "A", "T", 4), (day(0), "A", "T", 9), (day(6), "A", "T", 6), (day(7), "A", "T", 1)],
        "snapshot_date date, sku string, category string, stock_on_hand bigint",
    )
    got = windows.weekly_open_close(snap)
    assert listed(got, "week_start", "opening_stock", "closing_stock") == [(day(0), 9, 6), (day(7), 1, 1)]


def test_sell_through(spark):
    snap = spark.createDataFrame(
        [(day(0), "A", "T", 8), (day(0), "B", "T", 0)],
        "snapshot_date date, sku string, category string, stock_on_hand bigint",
    )
    s = sales(spark, *[{"sku": k, "quantity": 3} for k in "ABC"])
    got = marts.sales_velocity(s, snap)
    assert listed(got, "sku", "opening_stock", "sell_through_pct", "revenue_per_unit") == [
        ("A", 8, Decimal("37.5"), Decimal("10.00")),
        ("B", 0, None, Decimal("10.00")),
        ("C", 0, None, Decimal("10.00")),
    ]


def test_empty_inputs(spark):
    s, m = sales(spark), moves(spark)
    snap = marts.inventory_snapshot(s, m, D0, day(3))
    assert snap.count() == 0
    assert marts.sales_velocity(s, snap).count() == 0
    assert reports.category_daily_summary(snap).count() == 0
    assert reports.channel_revenue_weekly(s).count() == 0
    watch = reports.reorder_watchlist(snap, D0)
    kpis = reports.daily_kpis(watch, s, D0).collect()
    assert [tuple(r) for r in kpis] == [(D0, None, 0, 0, None, None, None, None)]

