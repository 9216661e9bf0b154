"""Daily activity per SKU and the dense per-day series built from it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from stockflow.functions.numeric import money, sum_money
from stockflow.functions.scalars import date, exprs


def daily_movements(stg_moves: DataFrame) -> DataFrame:
    """Net stock change per day, SKU and category."""
    return stg_moves.groupBy(*exprs("event_date AS movement_date", "sku", "category")).agg(
        *exprs("sum(stock_delta) AS net_delta")
    )


def daily_sales_outflow(stg_sales: DataFrame) -> DataFrame:
    """Units and revenue per day, SKU and category."""
    return stg_sales.groupBy(*exprs("event_date AS sale_date", "sku", "category")).agg(
        *exprs(
            "sum(quantity) AS units_sold",
            f"{sum_money('gross_revenue')} AS gross_revenue",
            f"{sum_money('net_revenue')} AS net_revenue",
        )
    )


def current_stock(raw_moves: DataFrame) -> DataFrame:
    """Stock per SKU from raw deltas."""
    return raw_moves.groupBy("sku").agg(*exprs("coalesce(sum(delta), 0L) AS current_stock"))


def sku_dimension(stg_sales: DataFrame, stg_moves: DataFrame) -> DataFrame:
    """Distinct (sku, category) seen in sales or movements."""
    columns = ["sku", "category"]
    return stg_sales.select(columns).unionByName(stg_moves.select(columns)).distinct()


def _days(first: str, last: str) -> str:
    return f"explode(sequence({first}, {last}, INTERVAL 1 DAY))"


def date_spine(spark: SparkSession, start: dt.date, as_of: dt.date) -> DataFrame:
    """One row per day from ``start`` to ``as_of``, both included."""
    return spark.range(1).selectExpr(f"{_days(date(start), date(as_of))} AS date_day")


def sku_date_spine(skus: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Every SKU on every day, by exploding the calendar inside each SKU row (no cross join)."""
    return skus.selectExpr(
        f"{_days(date(start), date(as_of))} AS snapshot_date", "sku", "category"
    )


#: A spine row's activity, 0 where there was none.
_ACTIVITY = [
    "snapshot_date",
    "sku",
    "category",
    "coalesce(net_delta, 0L) AS stock_received",
    "coalesce(units_sold, 0L) AS units_sold",
    f"{money('coalesce(gross_revenue, 0)')} AS gross_revenue",
    f"{money('coalesce(net_revenue, 0)')} AS net_revenue",
]


def join_activity(spine: DataFrame, moves: DataFrame, sales: DataFrame) -> DataFrame:
    """Left joins of daily activity on (sku, date).

    The category is not part of the join key: a SKU filed under two categories fans out.
    """
    m = moves.selectExpr("sku", "movement_date AS snapshot_date", "net_delta")
    s = sales.drop("category").withColumnRenamed("sale_date", "snapshot_date")
    joined = spine.join(m, ["sku", "snapshot_date"], "left")
    return joined.join(s, ["sku", "snapshot_date"], "left").selectExpr(*_ACTIVITY)


#: Change of stock over the rows that one active day of a SKU fans out to.
_FANNED_CHANGE = (
    "size(categories) * ("
    "greatest(1, size(sold)) * aggregate(moved, 0L, (t, m) -> t + m.net_delta) - "
    "greatest(1, size(moved)) * aggregate(sold, 0L, (t, s) -> t + s.units_sold))"
)


def dense_activity(
    stg_sales: DataFrame,
    stg_moves: DataFrame,
    start: dt.date,
    as_of: dt.date,
    skus: DataFrame | None = None,
    since: dt.date | None = None,
) -> DataFrame:
    """Same rows as ``join_activity(sku_date_spine(...))`` in two shuffles and one read.

    Sales and movements are aggregated together by (sku, category, day), which spreads a
    hot SKU over its days with map-side sums. Only the daily rows are then gathered by
    SKU, at most one per day and category, and each one is stretched up to the next
    active day. No join, no second pass over staging for the SKU list.

    With ``since`` only the days from there on are stretched; the column ``opening`` has what
    the SKU's earlier rows add up to.
    """
    return stretched_activity(daily_activity(stg_sales, stg_moves, start, as_of, skus), start, as_of, since)


def stretched_activity(
    daily: DataFrame, start: dt.date, as_of: dt.date, since: dt.date | None = None
) -> DataFrame:
    """The dense series of ``dense_activity`` from the rows of ``daily_activity``."""
    first = start if since is None else max(start, since)

    # Categories of the SKU's dimension rows; a struct keeps a NULL category.
    per_sku = daily.selectExpr(
        "*",
        "collect_set(CASE WHEN listed THEN struct(category) END) OVER (PARTITION BY sku) "
        "AS categories",
    )
    active = per_sku.groupBy("sku", "day").agg(
        *exprs(
            "first(categories) AS categories",
            "collect_list(CASE WHEN moves > 0 THEN struct(net_delta) END) AS moved",
            "collect_list(CASE WHEN sales > 0 THEN struct(units_sold, gross_revenue, net_revenue) "
            "END) AS sold",
        )
    )
    by_day = "OVER (PARTITION BY sku ORDER BY day)"
    earlier = f"CASE WHEN day < {date(first)} THEN {_FANNED_CHANGE} ELSE 0L END"
    stretched = active.selectExpr(
        "*",
        f"greatest({date(first)}, CASE WHEN lag(day) {by_day} IS NOT NULL THEN day END) AS first_day",
        f"coalesce(date_sub(lead(day) {by_day}, 1), {date(as_of)}) AS last_day",
        f"sum({earlier}) OVER (PARTITION BY sku) AS opening",
    ).filter("first_day <= last_day")
    dense = stretched.selectExpr("*", f"{_days('first_day', 'last_day')} AS snapshot_date")

    # Activity belongs to its own day only. Several categories fan out as in the joins.
    today = "CASE WHEN snapshot_date = day THEN"
    fanned = (
        dense.selectExpr(
            "sku",
            "opening",
            "snapshot_date",
            f"{today} moved END AS moved",
            f"{today} sold END AS sold",
            "explode(categories) AS c",
        )
        .selectExpr("*", "explode_outer(moved) AS m")
        .selectExpr("*", "explode_outer(sold) AS s")
    )
    return fanned.selectExpr(
        "snapshot_date", "sku", "opening", "c.category", "m.net_delta", "s.*"
    ).selectExpr(*_ACTIVITY, *([] if since is None else ["opening"]))


def daily_activity(
    stg_sales: DataFrame,
    stg_moves: DataFrame,
    start: dt.date,
    as_of: dt.date,
    skus: DataFrame | None = None,
) -> DataFrame:
    """Daily sums of both feeds per (sku, category, day).

    Rows outside the window keep their SKU in the list: they are filed on the first
    day with nothing moved or sold.
    """
    inside = f"CASE WHEN event_date BETWEEN {date(start)} AND {date(as_of)} THEN"
    day = f"{inside} event_date ELSE {date(start)} END AS day"
    listed = f"{str(skus is None).lower()} AS listed"
    feeds = stg_sales.selectExpr(
        "sku",
        "category",
        day,
        listed,
        f"{inside} cast(quantity AS bigint) END AS quantity",
        f"{inside} gross_revenue END AS gross_revenue",
        f"{inside} net_revenue END AS net_revenue",
    ).unionByName(
        stg_moves.selectExpr(
            "sku", "category", day, listed, f"{inside} cast(stock_delta AS bigint) END AS stock_delta"
        ),
        allowMissingColumns=True,
    )
    if skus is not None:
        given = skus.selectExpr("sku", "category", f"{date(start)} AS day", "true AS listed")
        feeds = feeds.unionByName(given, allowMissingColumns=True)
    return feeds.groupBy("sku", "category", "day").agg(
        *exprs(
            "max(listed) AS listed",
            "count(stock_delta) AS moves",
            "sum(stock_delta) AS net_delta",
            "count(quantity) AS sales",
            "sum(quantity) AS units_sold",
            f"{sum_money('gross_revenue')} AS gross_revenue",
            f"{sum_money('net_revenue')} AS net_revenue",
        )
    )
