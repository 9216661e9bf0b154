"""The daily category summary from the days on which something changes.

Stock, velocities, cover and flags of a SKU stay the same between two of its change points: a day
with activity, and the days on which a sale leaves the 7- and the 30-row frame. The summary adds
up the differences at those points and carries the sums over the days, so idle SKU-days are never
built: rows grow with the activity, not with SKUs times days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from stockflow.functions import numeric as N
from stockflow.functions import scalars as S
from stockflow.operators import daily
from stockflow.plans import marts

#: Columns of a SKU that last until its next change point, and those of one day alone.
_LEVELS = ("stock", "skus", "n_rows", "tenths", "covered", "reorder", "overstock", "cents_7d", "cents_30d")
_OWN = ("units", "gross", "net")
_SHORT, _LONG = 7, 30


def _point(day: str, stock: str = "0L", short: str = "0L", long: str = "0L", own: bool = False) -> str:
    parts = {"n": day, "d_stock": stock, "d_short": short, "d_long": long}
    parts |= {c: f"_{c}" if own else "0L" for c in _OWN}
    return f"named_struct({', '.join(f"'{name}', {value}" for name, value in parts.items())})"


def change_points(days: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """What changes per (sku, category, n), n the number of days since ``start``.

    ``days`` has a row per SKU and active day. An active day gives a point at most and two more for
    its sales to leave the frames. Frames grow during the first 30 days, so a SKU that sells
    then has a point on each of them; every SKU has one on the first day, where its rows begin.
    """
    n = f"datediff(day, {S.date(start)})"
    filed = days.selectExpr(
        "sku",
        "category",
        f"{n} AS _n",
        "coalesce(units_sold, 0L) AS _units",
        f"{N.cents('coalesce(gross_revenue, 0)')} AS _gross",
        f"{N.cents('coalesce(net_revenue, 0)')} AS _net",
        "coalesce(net_delta, 0L) AS _delta",
        "moves > 0 OR sales > 0 AS _active",
        # ``listed`` is read here too, so that this and the dense form share one aggregation.
        "listed AND day = min(day) OVER (PARTITION BY sku) AS _first",
        f"min(CASE WHEN units_sold <> 0 THEN {n} END) OVER (PARTITION BY sku) AS _sells",
    )
    growing = f"CASE WHEN _sells < {_LONG} THEN transform(sequence(_sells, {_LONG - 1}), d -> {_point('d')}) END"
    none = f"filter(array({_point('0')}), p -> false)"
    points = f"""concat(
        CASE WHEN _active THEN array({_point('_n', '_delta - _units', '_units', '_units', own=True)}) ELSE {none} END,
        CASE WHEN _units <> 0 THEN array({_point(f'_n + {_SHORT}', short='-_units')}, {_point(f'_n + {_LONG}', long='-_units')})
            ELSE {none} END,
        CASE WHEN _first THEN concat(array({_point('0')}), coalesce({growing}, {none})) ELSE {none} END)"""
    exploded = filed.selectExpr("sku", "category", f"inline({points})")
    changes = ("d_stock", "d_short", "d_long", *_OWN)
    return (
        exploded.filter(f"n <= {(as_of - start).days}")
        .groupBy("sku", "category", "n")
        .agg(*S.exprs(*[f"sum({c}) AS {c}" for c in changes]))
    )


def _levels(points: DataFrame) -> DataFrame:
    """Every SKU's levels from each of its points on."""
    series = "OVER (PARTITION BY sku ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    running = points.selectExpr(
        "sku",
        "category",
        "n",
        *_OWN,
        f"greatest(sum(d_stock) {series}, 0L) AS stock",
        f"sum(d_short) {series} AS units_short",
        f"sum(d_long) {series} AS units_long",
        f"cast(least(n + 1, {_SHORT}) AS bigint) AS rows_short",
        f"cast(least(n + 1, {_LONG}) AS bigint) AS rows_long",
    )
    cover = ("stock", "units_long", "rows_long")
    return running.selectExpr(
        "sku",
        "category",
        "n",
        *_OWN,
        "stock",
        "if(sku IS NULL, 0L, 1L) AS skus",
        "1L AS n_rows",
        f"coalesce(cast({S.days_on_hand(*cover)} * 10 AS bigint), 0L) AS tenths",
        "if(units_long > 0, 1L, 0L) AS covered",
        f"if({N.cover_below(*cover, S.REORDER_COVER_DAYS)}, 1L, 0L) AS reorder",
        f"if({N.cover_above(*cover, S.OVERSTOCK_COVER_DAYS)}, 1L, 0L) AS overstock",
        f"{N.cents(N.ratio_round('units_short', 'rows_short', 2))} AS cents_7d",
        f"{N.cents(N.ratio_round('units_long', 'rows_long', 2))} AS cents_30d",
    )


def _from_changes(days: DataFrame, start: dt.date, as_of: dt.date) -> DataFrame:
    """Sums per day and category of SKUs that have one row a day."""
    before = "OVER (PARTITION BY sku ORDER BY n)"
    steps = _levels(change_points(days, start, as_of)).selectExpr(
        "category", "n", *_OWN, *[f"{c} - lag({c}, 1, 0L) {before} AS {c}" for c in _LEVELS]
    )
    summed = steps.groupBy("category", "n").agg(*S.exprs(*[f"sum({c}) AS {c}" for c in (*_OWN, *_LEVELS)]))
    series = "OVER (PARTITION BY category ORDER BY n"
    carried = summed.selectExpr(
        "category",
        "n",
        *_OWN,
        *[f"sum({c}) {series} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}" for c in _LEVELS],
        f"lead(n, 1, {(as_of - start).days + 1}) {series}) AS until",
    )
    stretched = carried.selectExpr("*", "explode(sequence(n, until - 1)) AS d")
    own = [f"if(d = n, {c}, 0L) AS {c}" for c in _OWN]
    return stretched.selectExpr(f"date_add({S.date(start)}, d) AS snapshot_date", "category", *_LEVELS, *own)


def _from_rows(snapshot: DataFrame) -> DataFrame:
    """The same sums of a dense snapshot."""
    return snapshot.groupBy("snapshot_date", "category").agg(
        *S.exprs(
            "sum(stock_on_hand) AS stock",
            "count(DISTINCT sku) AS skus",
            "count(1) AS n_rows",
            "coalesce(sum(cast(days_on_hand * 10 AS bigint)), 0L) AS tenths",
            "count(days_on_hand) AS covered",
            "count(CASE WHEN is_reorder_required THEN 1 END) AS reorder",
            "count(CASE WHEN is_overstock THEN 1 END) AS overstock",
            f"{N.sum_cents('velocity_7d')} AS cents_7d",
            f"{N.sum_cents('velocity_30d')} AS cents_30d",
            "sum(units_sold) AS units",
            f"{N.sum_cents('gross_revenue')} AS gross",
            f"{N.sum_cents('net_revenue')} AS net",
        )
    )


def category_daily_summary(
    stg_sales: DataFrame, stg_moves: DataFrame, start: dt.date, as_of: dt.date
) -> DataFrame:
    """Same rows as ``reports.category_daily_summary`` of the whole snapshot, without building it.

    A SKU under several categories has several rows a day, over which its frames run; only such
    SKUs are built day by day. Staging is read once for both.
    """
    days = daily.daily_activity(stg_sales, stg_moves, start, as_of)
    counted = days.selectExpr(
        "*", "size(collect_set(CASE WHEN listed THEN struct(category) END) OVER (PARTITION BY sku)) AS _categories"
    )
    single, several = (counted.filter(f"_categories {rule} 1").drop("_categories") for rule in ("=", ">"))
    dense = marts.snapshot_columns(daily.stretched_activity(several, start, as_of))
    both = _from_changes(single, start, as_of).unionByName(_from_rows(dense))
    total = both.groupBy("snapshot_date", "category").agg(*S.exprs(*[f"sum({c}) AS {c}" for c in (*_LEVELS, *_OWN)]))
    return total.selectExpr(
        "snapshot_date",
        "category",
        "stock AS total_stock",
        "skus AS active_skus",
        "CASE WHEN covered > 0 THEN tenths / 10D / covered END AS avg_days_on_hand",
        "nullif(reorder, 0L) AS reorder_skus",
        "nullif(overstock, 0L) AS overstock_skus",
        "units AS units_sold",
        f"{N.ratio_round(N.wide('cents_7d'), N.wide('n_rows * 100'), 2)} AS avg_velocity_7d",
        f"{N.ratio_round(N.wide('cents_30d'), N.wide('n_rows * 100'), 2)} AS avg_velocity_30d",
        f"{N.from_cents('gross')} AS gross_revenue",
        f"{N.from_cents('net')} AS net_revenue",
        f"{N.percent(N.wide('gross - net'), N.wide('gross'), 2)} AS avg_discount_pct",
    )
