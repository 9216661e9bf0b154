"""Low-stock alerts from running stock, and their dispatch payload."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.scalars import exprs, instant
from stockflow.operators.dedup import first_wins
from stockflow.session import ensure_checkpoint_dir
from stockflow.sources.schemas import DEFAULT_THRESHOLD, REORDER_THRESHOLDS

DISPATCH_LIMIT = 50
_DISPATCH_ORDER = ["current_stock", "alert_ts", "sku", "category", "threshold"]


def with_threshold(
    df: DataFrame,
    thresholds: Mapping[str, int] = REORDER_THRESHOLDS,
    default: int = DEFAULT_THRESHOLD,
) -> DataFrame:
    """Look up the category's threshold, exactly as spelled; ``default`` when not listed."""
    spark = df.sparkSession
    table = spark.createDataFrame(list(thresholds.items()), "category string, threshold int")
    listed = df.join(F.broadcast(table), "category", "left")
    return listed.withColumn("threshold", F.expr(f"coalesce(threshold, {default})"))


def reorder_alerts(
    feed: DataFrame,
    arrival: Sequence[str],
    now: dt.datetime,
    duplicates: str = "realert",
    thresholds: Mapping[str, int] = REORDER_THRESHOLDS,
) -> DataFrame:
    """Alerts over a whole feed of stock movements, taken before de-duplication.

    Every event is checked against its SKU's running stock at its arrival. A repeated
    ``event_id`` adds nothing to stock but is checked again (``"realert"``), or is left
    out (``"ignore"``).
    """
    ensure_checkpoint_dir(feed.sparkSession)
    # The feed is read once: first arrivals, slices and checks all come from what is kept of it.
    columns = dict.fromkeys(["sku", "category", "event_id", "delta", *arrival])
    known = feed.filter("event_id IS NOT NULL").select(*columns).checkpoint()
    counted = first_wins(known, "event_id", arrival)
    checked = {"realert": known, "ignore": counted}[duplicates]
    return alert_rows(running_stock(checked, counted, arrival), now, thresholds)


def alert_rows(
    running: DataFrame, at: dt.datetime, thresholds: Mapping[str, int] = REORDER_THRESHOLDS
) -> DataFrame:
    """Rows whose running stock is below the threshold, in the shape of the alert table."""
    low = with_threshold(running, thresholds).filter("current_stock < threshold")
    return low.selectExpr(
        "sku",
        "category",
        "threshold",
        "cast(current_stock AS bigint) AS current_stock",
        f"{instant(at)} AS alert_ts",
        "false AS resolved",
    )


def running_stock(
    checked: DataFrame,
    counted: DataFrame,
    arrival: Sequence[str],
    opening: DataFrame | None = None,
) -> DataFrame:
    """``current_stock`` of the SKU right after each ``checked`` row.

    Stock is ``opening`` (sku, stock) plus the deltas of ``counted`` rows that arrived up to
    then. A SKU's timeline is not confined to one task: rows are range-partitioned by SKU and
    arrival, each slice is summed on its own, and a window over the slice totals (one row
    per SKU and slice) gives what came before. The checkpoint fixes the slice boundaries,
    which are sampled, for both uses.
    """
    ensure_checkpoint_dir(checked.sparkSession)
    order = ["sku", *arrival, "event_id", "is_check"]

    def marks(df: DataFrame, is_check: int, change: str) -> DataFrame:
        return df.filter("sku IS NOT NULL").selectExpr(
            "sku",
            "category",
            *arrival,
            "event_id",
            f"{is_check} AS is_check",
            f"cast({change} AS bigint) AS change",
            # Splits identical copies of one event, which share every other sort key.
            "spark_partition_id() AS part",
        )

    timeline = marks(counted, 0, "coalesce(delta, 0)").unionByName(marks(checked, 1, "0"))
    sliced = (
        timeline.repartitionByRange(*[F.col(c).asc_nulls_last() for c in (*order, "part")])
        .selectExpr("*", "spark_partition_id() AS slice")
        .drop("part")
        .checkpoint()
    )
    totals = sliced.groupBy("sku", "slice").agg(F.sum("change").alias("change"))
    before = "OVER (PARTITION BY sku ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    carried = totals.selectExpr("sku", "slice", f"coalesce(sum(change) {before}, 0L) AS carried")
    if opening is not None:
        carried = carried.join(opening, "sku", "left").selectExpr(
            "sku", "slice", "carried + coalesce(stock, 0L) AS carried"
        )
    sequence = ", ".join(f"{c} ASC NULLS LAST" for c in order[1:])
    so_far = f"""sum(change) OVER (PARTITION BY sku, slice ORDER BY {sequence}
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far"""
    return (
        sliced.selectExpr("*", so_far)
        .filter("is_check = 1")
        .join(carried, ["sku", "slice"])
        .selectExpr("sku", "category", "event_id", *arrival, "carried + so_far AS current_stock")
    )


def top_alerts(alerts: DataFrame, limit: int = DISPATCH_LIMIT) -> DataFrame:
    """The open alerts with the lowest stock; the extra keys make the choice among ties stable."""
    order = [F.col(c).asc_nulls_last() for c in _DISPATCH_ORDER]
    return (
        alerts.filter("NOT resolved")
        .orderBy(*order)
        .select("sku", "category", "threshold", "current_stock", "alert_ts")
        .limit(limit)
    )


#: Text with offset; microseconds only when there are any.
_ALERT_TIME = """date_format(alert_ts, CASE WHEN date_format(alert_ts, 'SSSSSS') = '000000'
    THEN 'yyyy-MM-dd HH:mm:ssxxx' ELSE 'yyyy-MM-dd HH:mm:ss.SSSSSSxxx' END)"""


def dispatch_payload(alerts: DataFrame, limit: int = DISPATCH_LIMIT) -> DataFrame:
    """The top alerts as one JSON array, lowest stock first; no row when nothing is open."""
    item = f"struct(sku, category, threshold, current_stock, {_ALERT_TIME} AS alert_ts)"
    # The leading fields repeat the choice order, so sorting the few structs restores it.
    ranked = f"struct({', '.join(_DISPATCH_ORDER)}, {item} AS item)"
    listed = top_alerts(alerts, limit).agg(
        *exprs("count(1) AS alert_count", f"sort_array(collect_list({ranked})) AS ranked")
    )
    return listed.filter("alert_count > 0").selectExpr(
        "alert_count", "to_json(transform(ranked, r -> r.item)) AS payload"
    )
