"""Window operators over the dense daily series and the weekly tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockflow.functions.numeric import money
from stockflow.functions.scalars import exprs, week_start

# Ties exist only where a SKU has several categories; the extra keys make them stable.
_SERIES = (
    "PARTITION BY sku ORDER BY snapshot_date, category, stock_received, units_sold, "
    "gross_revenue, net_revenue"
)


def with_running_stock(activity: DataFrame) -> DataFrame:
    """Running stock plus sum and row count of the 7- and 30-row sales frames.

    A frame's sum is the difference of two running sums, so each row costs the same
    whatever the frame's length, and one partitioning and one sort serve everything.
    Running stock may go below zero here; reports floor it.
    """
    to_date = f"OVER ({_SERIES} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    running = activity.selectExpr(
        "*",
        f"sum(stock_received - units_sold) {to_date} AS running_stock",
        f"sum(units_sold) {to_date} AS _units",
        f"row_number() OVER ({_SERIES}) AS _row",
    )

    def frame(days: int) -> list[str]:
        return [
            f"_units - lag(_units, {days}, 0L) OVER ({_SERIES}) AS units_{days}d",
            f"cast(least(_row, {days}) AS bigint) AS rows_{days}d",
        ]

    return running.selectExpr("*", *frame(7), *frame(30)).drop("_units", "_row")


def weekly_open_close(snapshot: DataFrame) -> DataFrame:
    """First and last daily stock of each SKU's week, one row per category of the SKU.

    "Opening" is the first day's end-of-day stock. Where a day has several stocks (a SKU under
    several categories) the week opens with the least and closes with the greatest. Rows are
    gathered once, by SKU and week; every step after that finds them there.
    """
    days = snapshot.selectExpr(
        "sku", f"{week_start('snapshot_date')} AS week_start", "category", "snapshot_date", "stock_on_hand"
    ).repartition("sku", "week_start")
    per_day = days.groupBy("sku", "week_start", "category", "snapshot_date").agg(
        *exprs("min(stock_on_hand) AS low", "max(stock_on_hand) AS high")
    )
    filed = per_day.groupBy("sku", "week_start", "category").agg(
        *exprs(
            "min(snapshot_date) AS first_day",
            "min_by(low, snapshot_date) AS first_stock",
            "max(snapshot_date) AS last_day",
            "max_by(high, snapshot_date) AS last_stock",
        )
    )
    week = "OVER (PARTITION BY sku, week_start)"
    return filed.selectExpr(
        "week_start",
        "sku",
        "category",
        f"min(struct(first_day, first_stock)) {week}.first_stock AS opening_stock",
        f"max(struct(last_day, last_stock)) {week}.last_stock AS closing_stock",
    )


def with_weekly_change(weekly: DataFrame) -> DataFrame:
    """Change against the SKU and channel's previous existing week, not the previous calendar week."""
    series = "OVER (PARTITION BY sku, channel ORDER BY week_start, category, units_sold, net_revenue)"
    return weekly.selectExpr(
        "*",
        f"units_sold - lag(units_sold) {series} AS wow_units_delta",
        f"{money(f'net_revenue - lag(net_revenue) {series}')} AS wow_revenue_delta",
    )


def latest_per_sku(snapshot: DataFrame) -> DataFrame:
    """The newest snapshot row of each SKU; category decides ties."""
    ranked = snapshot.selectExpr(
        "*",
        "row_number() OVER (PARTITION BY sku ORDER BY snapshot_date DESC NULLS FIRST, "
        "category ASC NULLS LAST) AS _rn",
    )
    return ranked.filter("_rn = 1").drop("_rn")
