"""Business reports over the marts, and the order in which each is shown."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions import numeric as N
from stockflow.functions import scalars as S
from stockflow.operators.windows import latest_per_sku


def category_daily_summary(snapshot: DataFrame) -> DataFrame:
    """Stock, velocity and revenue per day and category.

    Flag counts are NULL, not 0, when no SKU carries the flag. ``avg_days_on_hand`` is the
    exact sum divided once, unrounded.
    """
    gross, net = N.sum_cents("gross_revenue"), N.sum_cents("net_revenue")
    tenths = "sum(cast(days_on_hand * 10 AS bigint))"
    return snapshot.groupBy("snapshot_date", "category").agg(
        *S.exprs(
            "sum(stock_on_hand) AS total_stock",
            "count(DISTINCT sku) AS active_skus",
            f"CASE WHEN count(days_on_hand) > 0 THEN {tenths} / 10D / count(days_on_hand) END "
            "AS avg_days_on_hand",
            "sum(CASE WHEN is_reorder_required THEN 1L END) AS reorder_skus",
            "sum(CASE WHEN is_overstock THEN 1L END) AS overstock_skus",
            "sum(units_sold) AS units_sold",
            f"{N.mean_round('velocity_7d')} AS avg_velocity_7d",
            f"{N.mean_round('velocity_30d')} AS avg_velocity_30d",
            f"{N.from_cents(gross)} AS gross_revenue",
            f"{N.from_cents(net)} AS net_revenue",
            f"{N.percent(N.wide(f'{gross} - {net}'), N.wide(gross), 2)} AS avg_discount_pct",
        )
    )


def reorder_watchlist(snapshot: DataFrame, as_of: dt.date) -> DataFrame:
    """Every SKU of the day with urgency tier and suggested order; empty without that day.

    The tier reads rounded cover while the reorder flag reads exact cover, so 20.96 days
    is flagged and still HEALTHY.
    """
    today = latest_per_sku(snapshot.filter(f"snapshot_date = {S.date(as_of)}"))
    return today.selectExpr(
        "sku",
        "category",
        "stock_on_hand",
        "units_sold AS units_sold_today",
        "velocity_7d",
        "velocity_30d",
        "days_on_hand",
        "is_reorder_required",
        "is_overstock",
        f"{S.urgency_tier('stock_on_hand', 'days_on_hand')} AS stock_status",
        f"{S.reorder_quantity('velocity_30d', 'stock_on_hand')} AS suggested_reorder_qty",
    )


def channel_revenue_weekly(stg_sales: DataFrame) -> DataFrame:
    """Revenue, units, distinct SKUs and transactions per week, channel and category.

    The first aggregate has a row per transaction of a group, with its sums and its SKUs; a hot
    transaction comes down to that in every map task. Each such row then gives its sums once and
    each SKU once, which the second aggregate brings down to a row per SKU of a group before the
    last one counts them. Rows are read once and not doubled for the two distinct counts.
    """
    keys = ["week_start", "channel", "category"]
    sums = {
        "units": "quantity",
        "net": N.cents("net_revenue"),
        "gross": N.cents("gross_revenue"),
        "discounts": N.cents("discount_pct"),
    }
    weekly = stg_sales.withColumn("week_start", F.expr(S.week_start("event_date")))
    baskets = weekly.groupBy(*keys, "transaction_id").agg(
        *S.exprs(*[f"sum({value}) AS {name}" for name, value in sums.items()]),
        *S.exprs("count(discount_pct) AS discounted", "collect_set(sku) AS skus"),
    )
    total = [*sums, "discounted", "transactions"]
    once = f"named_struct('sku', string(NULL), 'transactions', int(transaction_id IS NOT NULL), {', '.join(f'{n!r}, {n}' for n in total[:-1])})"
    nothing = ", ".join(f"{n!r}, bigint(NULL)" for n in total[:-1])
    each = f"transform(skus, s -> named_struct('sku', s, 'transactions', int(NULL), {nothing}))"
    parts = baskets.selectExpr(*keys, f"inline(concat(array({once}), {each}))")
    adding = S.exprs(*[f"sum({n}) AS {n}" for n in total])
    per_sku = parts.groupBy(*keys, "sku").agg(*adding)
    merged = per_sku.groupBy(*keys).agg(*S.exprs("count(sku) AS active_skus"), *adding)
    return merged.selectExpr(
        *keys,
        "active_skus",
        "units AS units_sold",
        f"{N.from_cents('net')} AS net_revenue",
        f"{N.from_cents('gross')} AS gross_revenue",
        f"{N.ratio_round(N.wide('discounts'), N.wide('discounted * 100'), 2)} AS avg_discount_pct",
        "transactions",
        f"{N.ratio_round(N.wide('net'), N.wide('transactions * 100'), 2)} AS avg_basket_value",
    )


def supplier_performance(raw_deliveries: DataFrame, business_tz: str | None = None) -> DataFrame:
    """Deliveries, cost, on-time share and mean lead variance per supplier and month.

    Only delivered orders count: a supplier that never delivers has no row. The cost is exact for
    any quantity and price.
    """
    month = S.month_start(f"cast({S.local_time('ts', business_tz)} AS date)")
    on_time = "count(CASE WHEN actual_date <= expected_date THEN 1 END)"
    late = "datediff(actual_date, expected_date)"
    return (
        raw_deliveries.filter("actual_date IS NOT NULL")
        .groupBy(*S.exprs("supplier_id", f"{month} AS month"))
        .agg(
            *S.exprs(
                "count(1) AS total_deliveries",
                "sum(quantity) AS total_units_received",
                f"cast(sum({S.exact_line('quantity', 'unit_cost')}) AS {N.WIDE_MONEY}) AS total_cost",
                f"{N.percent(on_time, 'count(1)', 1)} AS on_time_pct",
                f"{N.ratio_round(f'sum({late})', f'count({late})', 1)} AS avg_lead_variance_days",
            )
        )
    )


def daily_kpis(watchlist: DataFrame, stg_sales: DataFrame, as_of: dt.date) -> DataFrame:
    """One row of figures for the day, also when there is no stock or no sale.

    Two single-row aggregates put side by side by a second aggregate, not a cross join.
    """
    mean_days = N.ratio_round(
        "sum(cast(days_on_hand * 10 AS bigint))", "count(days_on_hand) * 10", 1
    )
    in_stock = "count(CASE WHEN stock_on_hand > 0 THEN 1 END)"
    health = watchlist.agg(
        *S.exprs(
            "sum(stock_on_hand) AS total_units_on_hand",
            "count(DISTINCT sku) AS total_active_skus",
            "count(CASE WHEN stock_status IN ('CRITICAL', 'OUT_OF_STOCK') THEN 1 END) "
            "AS critical_sku_count",
            f"{mean_days} AS avg_days_on_hand",
            f"{N.percent(in_stock, 'count(1)', 1)} AS fill_rate_pct",
        )
    )
    sales = stg_sales.filter(f"event_date = {S.date(as_of)}").agg(
        *S.exprs(
            f"{N.sum_money('net_revenue')} AS revenue_today",
            "sum(quantity) AS units_sold_today",
        )
    )
    figures = [
        "total_units_on_hand",
        "total_active_skus",
        "critical_sku_count",
        "avg_days_on_hand",
        "revenue_today",
        "units_sold_today",
        "fill_rate_pct",
    ]
    both = health.unionByName(sales, allowMissingColumns=True)
    return both.agg(
        *S.exprs(f"{S.date(as_of)} AS kpi_date", *[f"max({f}) AS {f}" for f in figures])
    )


#: Reading order of each report. Stored tables stay unordered.
SHOWN_BY = {
    "fct_sales_velocity": "week_start DESC NULLS FIRST, net_revenue DESC NULLS FIRST",
    "mv_category_daily_summary": "snapshot_date DESC NULLS FIRST, gross_revenue DESC NULLS FIRST",
    "mv_sku_reorder_watchlist": "days_on_hand ASC NULLS FIRST",
    "mv_channel_revenue_weekly": "week_start DESC NULLS FIRST, net_revenue DESC NULLS FIRST",
    "mv_supplier_performance": "month DESC NULLS FIRST, on_time_pct ASC NULLS LAST",
}


def shown(name: str, df: DataFrame) -> DataFrame:
    """``df`` in the reading order of report ``name``."""
    return df.sparkSession.sql(f"SELECT * FROM {{df}} ORDER BY {SHOWN_BY[name]}", df=df)
