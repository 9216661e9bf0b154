"""One scheduled run: gate, staging, tests, marts, tests, then alerts and reports."""

from __future__ import annotations

import datetime as dt
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession

from stockflow.operators import alerts, quality, staging
from stockflow.plans import incremental, reports, staging_tables
from stockflow.session import pin_session
from stockflow.sources import parts, tables
from stockflow.sources.schemas import DAY_OF

#: Staging table -> (its raw table, how it is cleaned)
STAGING = {
    "stg_sales": ("raw_sales", staging.stg_sales),
    "stg_stock_movements": ("raw_stock_movements", staging.stg_stock_movements),
}
#: Stored report -> (its input table, how it is computed)
REPORTS = {
    "mv_category_daily_summary": (
        "fct_inventory_snapshot",
        lambda df, as_of, tz: reports.category_daily_summary(df),
    ),
    "mv_sku_reorder_watchlist": (
        "fct_inventory_snapshot",
        lambda df, as_of, tz: reports.reorder_watchlist(df, as_of),
    ),
    "mv_channel_revenue_weekly": (
        "stg_sales",
        lambda df, as_of, tz: reports.channel_revenue_weekly(df),
    ),
    "mv_supplier_performance": (
        "raw_supplier_deliveries",
        lambda df, as_of, tz: reports.supplier_performance(df, tz),
    ),
}


#: Reports that are computed whole: of one day, and from late-arriving deliveries.
WHOLE_REPORTS = ("mv_sku_reorder_watchlist", "mv_supplier_performance")


def _input(spark: SparkSession, root: str, name: str) -> DataFrame:
    if name == incremental.SNAPSHOT:
        return parts.read(spark, root, name).drop("running_stock")
    if name.startswith("raw_"):
        return tables.committed(spark, root, name)
    return tables.read_current(spark, root, name)


def refresh_report(
    spark: SparkSession, root: str, name: str, as_of: dt.date, business_tz: str | None = None
) -> DataFrame:
    """Recompute one stored report; readers keep the old version until the new one is finished."""
    source, compute = REPORTS[name]
    if name == "mv_sku_reorder_watchlist":
        today = parts.read(spark, root, source, None, lambda part: part == as_of.isoformat())
        return tables.rebuild(compute(today.drop("running_stock"), as_of, business_tz), root, name)
    result = compute(_input(spark, root, source), as_of, business_tz)
    return tables.rebuild(result, root, name)


def daily_kpis(spark: SparkSession, root: str, as_of: dt.date) -> DataFrame:
    """The day's figures from the stored watchlist and staging."""
    watchlist = tables.read_current(spark, root, "mv_sku_reorder_watchlist")
    return reports.daily_kpis(watchlist, tables.read_current(spark, root, "stg_sales"), as_of)


def check(models: dict[str, DataFrame]) -> None:
    found = [quality.model_report(name, df) for name, df in models.items()]
    quality.assert_models(reduce(DataFrame.unionByName, found))


def refresh_staging(
    spark: SparkSession,
    root: str,
    last: int,
    mode: str = "incremental",
    overlap: dt.timedelta | None = None,
    business_tz: str | None = None,
) -> dict[str, DataFrame]:
    """Bring the staging tables up to ingest batch ``last``, test what was written, return them.

    An incremental run reads the batches stored since the last run whose tests passed, and tests
    the days it wrote: an event never changes its day, so a repeated id would lie within one of
    them. ``overlap`` finds new rows by ingest time instead, and tests the whole tables.
    """
    staged = {}
    for name, (source, clean) in STAGING.items():
        done = tables.staged_upto(spark, root, name) if mode == "incremental" and not overlap else None
        # Raw keeps the first arrival of an event for good, so its day never changes.
        staged[name] = staging_tables.refresh_days(
            tables.committed(spark, root, source, upto=last),
            partial(clean, business_tz=business_tz),
            root,
            name,
            mode,
            overlap,
            days_fixed=True,
            newer=None if done is None else tables.committed(spark, root, source, done, last),
        )
        if done is None:
            # What an earlier run wrote and did not test is not known.
            staged[name] = staged[name]._replace(days=None)
    check({name: found.touched() for name, found in staged.items()})
    for name in STAGING:
        tables.mark_staged(spark, root, name, last)
    return {name: found.table for name, found in staged.items()}


def refresh_rejected(
    spark: SparkSession, root: str, last: int, after: int | None = None, full: bool = False
) -> DataFrame:
    """Store the sales that staging has no room for, with the reason, and return all of them.

    They are filed by ingest batch, so batches that are read again replace their own rows.
    """
    rows = tables.read_batches(spark, root, "raw_sales", -1 if after is None or full else after, last)
    rejected = staging.oversized_sales(rows)
    path = f"{root}/rejected_sales"
    how = "static" if full else "dynamic"
    rejected.write.mode("overwrite").option("partitionOverwriteMode", how).partitionBy("batch_id").parquet(path)
    return spark.read.schema(rejected.schema).parquet(path).select(rejected.columns)


def run_hourly(
    spark: SparkSession,
    root: str,
    as_of: dt.date,
    now: dt.datetime,
    start: dt.date,
    mode: str = "incremental",
    overlap: dt.timedelta | None = None,
    business_tz: str | None = None,
) -> dict[str, DataFrame]:
    """Run every step in order; a failed gate or test stops the run before later steps write.

    The caller chooses ``mode``: "incremental", which computes what the new batches change, or
    "full" for the nightly rebuild. Marts are tested before readers see them. The result has
    every table, among them ``rejected_sales``: what staging could not hold, and why.
    """
    pin_session(spark)
    last = tables.last_committed(spark, root)
    raw = {
        name: tables.committed(spark, root, name, upto=last)
        for name in ("raw_sales", "raw_stock_movements", "raw_supplier_deliveries")
    }
    quality.assert_fresh(quality.freshness_report(raw, now))

    done = tables.staged_upto(spark, root, "stg_sales")
    staged = refresh_staging(spark, root, last, mode, overlap, business_tz)
    rejected = refresh_rejected(spark, root, last, done, full=mode == "full")
    sales, moves = (staged[name] for name in STAGING)

    def fresh(after: int) -> tuple[DataFrame, DataFrame]:
        """Staging rows of the ingest batches past ``after``."""
        newer = (
            clean(tables.committed(spark, root, source, after, last), business_tz=business_tz)
            for source, clean in STAGING.values()
        )
        return tuple(newer)

    snapshot, change = incremental.refresh_snapshot(
        spark, root, sales, moves, fresh, last, start, as_of, check, full=mode == "full"
    )
    velocity = incremental.refresh_velocity(spark, root, sales, change, check)

    payload = tables.rebuild(
        alerts.dispatch_payload(tables.committed(spark, root, "reorder_alerts")),
        root,
        "alert_payload",
    )
    views = {
        "mv_category_daily_summary": incremental.refresh_category_summary(spark, root, change),
        "mv_channel_revenue_weekly": incremental.refresh_channel_revenue(spark, root, sales, change),
        **{name: refresh_report(spark, root, name, as_of, business_tz) for name in WHOLE_REPORTS},
    }
    for name in DAY_OF:
        tables.compact(spark, root, name, tables.LOOSE_BATCHES)
    return {
        "stg_sales": sales,
        "stg_stock_movements": moves,
        "rejected_sales": rejected,
        "fct_inventory_snapshot": snapshot,
        "fct_sales_velocity": velocity,
        "alert_payload": payload,
        **views,
        "vw_daily_kpis": daily_kpis(spark, root, as_of),
    }
