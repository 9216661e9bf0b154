"""Daily inventory snapshot and weekly sales velocity."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame

from stockflow.functions import numeric as N
from stockflow.functions import scalars as S
from stockflow.operators import daily, windows


def inventory_snapshot(
    stg_sales: DataFrame,
    stg_moves: DataFrame,
    start: dt.date,
    as_of: dt.date,
    skus: DataFrame | None = None,
) -> DataFrame:
    """Stock, velocity and cover flags for every SKU on every day of ``[start, as_of]``."""
    return snapshot_columns(daily.dense_activity(stg_sales, stg_moves, start, as_of, skus))


def inventory_at(
    stg_sales: DataFrame, stg_moves: DataFrame, start: dt.date, as_of: dt.date
) -> DataFrame:
    """The rows that ``inventory_snapshot`` has for the day ``as_of``.

    The longest frame is 30 rows and a SKU has one a day at least, so only the last 30 days are
    built; what came before enters as one opening stock per SKU.
    """
    since = as_of - dt.timedelta(days=29)
    recent = daily.dense_activity(stg_sales, stg_moves, start, as_of, since=since)
    return snapshot_columns(recent, "opening").filter(f"snapshot_date = {S.date(as_of)}")


def snapshot_columns(activity: DataFrame, opening: str = "0L", keep: Sequence[str] = ()) -> DataFrame:
    """Snapshot from a dense daily series. Flags use exact cover, ``days_on_hand`` is rounded.

    ``keep`` adds columns of the series, such as ``running_stock``, which is not floored.
    """
    cover = ("stock_on_hand", "units_30d", "rows_30d")
    floored = windows.with_running_stock(activity).selectExpr(
        "*", f"greatest(running_stock + {opening}, 0L) AS stock_on_hand"
    )
    return floored.selectExpr(
        "snapshot_date",
        "sku",
        "category",
        "stock_on_hand",
        "units_sold",
        "gross_revenue",
        "net_revenue",
        f"{N.ratio_round('units_7d', 'rows_7d', 2)} AS velocity_7d",
        f"{N.ratio_round('units_30d', 'rows_30d', 2)} AS velocity_30d",
        f"{S.days_on_hand(*cover)} AS days_on_hand",
        f"{N.cover_below(*cover, S.REORDER_COVER_DAYS)} AS is_reorder_required",
        f"{N.cover_above(*cover, S.OVERSTOCK_COVER_DAYS)} AS is_overstock",
        *keep,
    )


def weekly_sales(stg_sales: DataFrame) -> DataFrame:
    """Units, revenue, transactions and mean discount per week, category, channel and SKU.

    The distinct count makes Spark shuffle on the group plus ``transaction_id``, so a hot
    group is spread before its final merge.
    """
    keys = S.exprs(f"{S.week_start('event_date')} AS week_start", "category", "channel", "sku")
    return stg_sales.groupBy(*keys).agg(
        *S.exprs(
            "sum(quantity) AS units_sold",
            f"{N.sum_money('net_revenue')} AS net_revenue",
            "count(DISTINCT transaction_id) AS transactions",
            f"{N.mean_round('discount_pct')} AS avg_discount_pct",
        )
    )


def sales_velocity(stg_sales: DataFrame, snapshot: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Weekly sales with opening and closing stock, sell-through and week-over-week change.

    Sell-through divides one channel's units by the opening stock of all channels. ``prior`` has
    rows of earlier weeks to compare with, where ``stg_sales`` begins later; they come back too.
    """
    stock = windows.weekly_open_close(snapshot).drop("category")
    weekly = weekly_sales(stg_sales)
    if prior is not None:
        weekly = weekly.unionByName(prior, allowMissingColumns=True)
    joined = weekly.join(stock, ["sku", "week_start"], "left")
    per_unit = N.ratio_round(N.wide(N.cents("net_revenue")), N.wide("units_sold * 100"), 2)
    return windows.with_weekly_change(joined).selectExpr(
        "week_start",
        "category",
        "channel",
        "sku",
        "units_sold",
        "net_revenue",
        "transactions",
        "avg_discount_pct",
        "coalesce(opening_stock, 0L) AS opening_stock",
        "coalesce(closing_stock, 0L) AS closing_stock",
        f"{N.percent('units_sold', 'coalesce(opening_stock, 0L)', 1)} AS sell_through_pct",
        f"{per_unit} AS revenue_per_unit",
        "wow_units_delta",
        "wow_revenue_delta",
    )
