"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions import numeric as N
from stockflow.functions import scalars as S
from stockflow.operators import alerts, daily, dedup, quality, staging, upsert, windows
from stockflow.plans import change_points, hourly, marts, reports, staging_tables
from stockflow.session import ensure_checkpoint_dir, pin_session
from stockflow.sources import commits, feeds, messages, tables
from stockflow.sources.schemas import RAW_SALES, STOCK_TOPIC, STOCK_WIRE
from stockflow.streaming import ingest

# The whole calendar of the given tables but its last day, which the as-of cut-off drops.
START = dt.date(1995, 1, 1)
AS_OF = dt.date(2001, 11, 3)
NOW = dt.datetime(2001, 11, 3, 23, 59, 59)
#: Splits the feeds into a stored part and a newer one for the incremental operators.
MARK = dt.datetime(1998, 7, 1)
#: The calendar of the streamed events.
STREAM_START, STREAM_AS_OF = dt.date(2024, 1, 1), dt.date(2024, 1, 30)

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Raw and derived tables of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = pin_session(spark), sf_dir

    def feed(self, feed: feeds.Feed) -> DataFrame:
        return feed(self.spark, self.sf_dir)

    def raw(self, feed: feeds.Feed) -> DataFrame:
        return feeds.raw(feed, self.spark, self.sf_dir)

    def sales(self) -> DataFrame:
        return staging.stg_sales(self.raw(feeds.sales_feed))

    def moves(self) -> DataFrame:
        return staging.stg_stock_movements(self.raw(feeds.movements_feed))

    def activity(self) -> DataFrame:
        return daily.dense_activity(self.sales(), self.moves(), START, AS_OF)

    def snapshot(self) -> DataFrame:
        return marts.inventory_snapshot(self.sales(), self.moves(), START, AS_OF)

    def watchlist(self) -> DataFrame:
        at = marts.inventory_at(self.sales(), self.moves(), START, AS_OF)
        return reports.reorder_watchlist(at, AS_OF)

    def alerts(self, duplicates: str = "realert") -> DataFrame:
        feed = self.feed(feeds.movements_feed)
        return alerts.reorder_alerts(feed, feeds.ARRIVAL, NOW, duplicates)

    def stock_events(self) -> DataFrame:
        e = feeds.envelope_events(self.spark, self.sf_dir).filter(F.col("topic") == STOCK_TOPIC)
        return e.withColumnRenamed("msg_id", "event_id")

    def slices(self) -> tuple[DataFrame, DataFrame]:
        """First arrivals of the sales feed up to the mark, and after it."""
        feed = self.feed(feeds.sales_feed)
        old, new = (
            dedup.first_wins(feed.filter(part), "event_id", feeds.ARRIVAL).drop("arrival_key")
            for part in (f"ingested_at <= {S.instant(MARK)}", f"ingested_at > {S.instant(MARK)}")
        )
        return old, new


def _weekly(i: Inputs) -> DataFrame:
    return windows.with_weekly_change(marts.weekly_sales(i.sales()))


def _rolling(i: Inputs) -> DataFrame:
    return windows.with_running_stock(i.activity()).selectExpr(
        *_SKU_DAY,
        f"{N.ratio_round('units_7d', 'rows_7d', 2)} AS velocity_7d",
        f"{N.ratio_round('units_30d', 'rows_30d', 2)} AS velocity_30d",
    )


def _sales_calendar(i: Inputs) -> DataFrame:
    """Every day of the calendar with its number of sales, 0 on quiet days."""
    per_day = i.sales().groupBy(F.col("event_date").alias("date_day")).agg(
        F.expr("count(1) AS sales")
    )
    spine = daily.date_spine(i.spark, START, AS_OF)
    return spine.join(per_day, "date_day", "left").selectExpr(
        "date_day", "coalesce(sales, 0L) AS sales"
    )


def _spine_joins(i: Inputs) -> DataFrame:
    sales, moves = i.sales(), i.moves()
    spine = daily.sku_date_spine(daily.sku_dimension(sales, moves), START, AS_OF)
    return daily.join_activity(
        spine, daily.daily_movements(moves), daily.daily_sales_outflow(sales)
    )


def _upsert(i: Inputs) -> DataFrame:
    old, new = i.slices()
    return upsert.upsert(staging.stg_sales(old), staging.stg_sales(new))


def _unseen(i: Inputs) -> DataFrame:
    old, new = i.slices()
    return dedup.unseen(new, old, "event_id")


def _freshness(i: Inputs) -> DataFrame:
    return quality.freshness_report(
        {
            "raw_sales": i.raw(feeds.sales_feed),
            "raw_stock_movements": i.raw(feeds.movements_feed),
            "raw_supplier_deliveries": i.raw(feeds.deliveries_feed),
        },
        NOW,
    )


def _schema_sync(i: Inputs) -> DataFrame:
    """The stored part lacks one column of the new rows and has one that they dropped."""
    old, new = (staging.stg_sales(part) for part in i.slices())
    return upsert.upsert(old.drop("color").selectExpr("*", "1 AS retired"), new)


def _streamed_alerts(i: Inputs) -> DataFrame:
    """Alerts as the stream raises them: three arrivals of files, a restart before each."""
    ensure_checkpoint_dir(i.spark)
    work = f"{i.spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    sent = feeds.envelope(i.spark, i.sf_dir)
    for part in _ARRIVALS:
        sent.filter(part).write.mode("append").parquet(f"{work}/source")
        _ingest_available(i, work, "progress", sent.schema)
    return tables.committed(i.spark, f"{work}/tables", "reorder_alerts")


#: Three arrivals of files that hold every event.
_ARRIVALS = [
    "timestamp < '2024-01-11' OR timestamp IS NULL",
    "timestamp >= '2024-01-11' AND timestamp < '2024-01-21'",
    "timestamp >= '2024-01-21'",
]


def _ingest_available(i: Inputs, work: str, progress: str, schema) -> None:
    stream = messages.file_stream(i.spark, f"{work}/source", schema)
    ingest.start_ingest(
        stream, f"{work}/tables", f"{work}/{progress}", ["arrival"], clock=lambda: NOW
    ).awaitTermination()


_STORED: dict[tuple[str, str], str] = {}


def _stored_ingest(i: Inputs) -> str:
    """Root of tables that a stream stored, run once per session and data folder.

    Three arrivals with a restart before each, then a lost checkpoint: another one reads all
    messages again into the same root, which must store nothing twice.
    """
    ensure_checkpoint_dir(i.spark)
    known = (i.spark.sparkContext.applicationId, i.sf_dir)
    if known not in _STORED:
        work = f"{i.spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
        sent = feeds.envelope(i.spark, i.sf_dir)
        for part in _ARRIVALS:
            sent.filter(part).write.mode("append").parquet(f"{work}/source")
            _ingest_available(i, work, "progress", sent.schema)
        _ingest_available(i, work, "progress-reset", sent.schema)
        _STORED[known] = f"{work}/tables"
    return _STORED[known]


def _stored_raw(i: Inputs, table: str) -> DataFrame:
    stored = tables.committed(i.spark, _stored_ingest(i), table)
    return stored.select("event_id", "event_type", "ts", "sku", "category", "ingested_at")


def _stored_dead_letters(i: Inputs) -> DataFrame:
    """Each rejected message once, though a lost checkpoint had all of them read again."""
    stored = tables.committed(i.spark, _stored_ingest(i), "dead_letters")
    return stored.selectExpr(
        "topic", "key", "get_json_object(value, '$.event_id') AS event_id", "reason", "raw_value = cast(value AS binary) AS same_bytes"
    )


def _stored_staging(i: Inputs) -> str:
    """Root whose stored staging was rebuilt after the first batch and upserted with the rest."""
    root = _stored_ingest(i)
    if tables.staged_upto(i.spark, root, "stg_sales") is None:
        for last in (0, tables.last_committed(i.spark, root)):
            hourly.refresh_staging(i.spark, root, last)
    return root


def _stored_table(i: Inputs, name: str) -> DataFrame:
    return tables.read_current(i.spark, _stored_staging(i), name)


def _stored_report(i: Inputs, name: str) -> DataFrame:
    return hourly.refresh_report(i.spark, _stored_staging(i), name, AS_OF)


def _stored_schema_sync(i: Inputs) -> DataFrame:
    """Stored staging of an older build: one column less, one more, one narrower."""
    root = _stored_ingest(i)
    kept = f"{root}-sync-{uuid.uuid4().hex}"

    def older(raw: DataFrame) -> DataFrame:
        changed = {"quantity": F.expr("cast(quantity AS smallint)"), "retired": F.lit(1)}
        return staging.stg_sales(raw).withColumns(changed).drop("color")

    raw, newer = (tables.committed(i.spark, root, "raw_sales", **part) for part in ({"upto": 0}, {"after": 0}))
    staging_tables.refresh(raw, older, kept, "stg_sales")
    return staging_tables.refresh_days(
        newer, staging.stg_sales, kept, "stg_sales", days_fixed=True, newer=newer
    ).table


#: Three arrivals of all events; the last brings some of two days that were closed before.
_LATE = "timestamp >= '2024-01-14' AND timestamp < '2024-01-16' AND arrival % 7 = 0 AND arrival % 10 NOT IN (4, 9)"
_HOURS = [
    (f"timestamp < '2024-01-16' AND NOT ({_LATE})", dt.date(2024, 1, 16)),
    ("timestamp >= '2024-01-16' AND timestamp < '2024-01-26'", dt.date(2024, 1, 25)),
    (f"timestamp >= '2024-01-26' OR ({_LATE})", STREAM_AS_OF),
]
_RUNS: dict[tuple[str, str, str], dict[str, DataFrame]] = {}


def _hourly(i: Inputs, mode: str, table: str) -> DataFrame:
    """A table of scheduled runs over stored events, made once per session and data folder.

    ``incremental`` runs after each of three arrivals, ``full`` once after all of them.
    """
    ensure_checkpoint_dir(i.spark)
    known = (i.spark.sparkContext.applicationId, i.sf_dir, mode)
    if known not in _RUNS:
        root = f"{i.spark.sparkContext.getCheckpointDir()}/hourly-{uuid.uuid4().hex}"
        tables.ensure_tables(i.spark, root)
        sent = feeds.envelope(i.spark, i.sf_dir, one_category=True)
        for n, (part, as_of) in enumerate(_HOURS):
            ingest.ingest_batch(sent.filter(part), root, n, NOW, ["arrival"])
            if mode == "incremental" or n == len(_HOURS) - 1:
                _RUNS[known] = hourly.run_hourly(i.spark, root, as_of, NOW, STREAM_START, mode)
    return _RUNS[known][table]


def _bulk(i: Inputs, feed: feeds.Feed, price: str) -> DataFrame:
    """A raw feed in bulk: lines up to 10^15, as amounts beyond what staging holds need."""
    grown = {"quantity": F.expr("quantity * 10000000"), price: F.expr(f"cast({price} * 1000 AS decimal(12,2))")}
    return i.raw(feed).withColumns(grown)


def _rejected(i: Inputs) -> DataFrame:
    """Sales in bulk that a run stores apart, with the reason."""
    ensure_checkpoint_dir(i.spark)
    root = f"{i.spark.sparkContext.getCheckpointDir()}/bulk-{uuid.uuid4().hex}"
    tables.ensure_tables(i.spark, root)
    sales = _bulk(i, feeds.sales_feed, "unit_price").select(RAW_SALES.names)
    folder = tables.write_batch(sales, root, "raw_sales", 0)
    commits.commit(i.spark, root, lambda last: commits.replace(last, batch=0, live={"raw_sales": [(0, folder)]}))
    return hourly.refresh_rejected(i.spark, root, 0).select("event_id", "sku", "quantity", "unit_price", "discount_pct", "reason")


def _staging_tests(i: Inputs) -> DataFrame:
    return quality.model_report("stg_sales", i.sales()).unionByName(
        quality.model_report("stg_stock_movements", i.moves())
    )


def _mart_tests(i: Inputs) -> DataFrame:
    snapshot = i.snapshot()
    return quality.model_report("fct_inventory_snapshot", snapshot).unionByName(
        quality.model_report("fct_sales_velocity", marts.sales_velocity(i.sales(), snapshot))
    )


def _roundtrip(i: Inputs) -> DataFrame:
    stock = feeds.envelope(i.spark, i.sf_dir).filter(F.col("topic") == STOCK_TOPIC)
    return messages.events(messages.decode(stock, STOCK_WIRE), STOCK_WIRE, ["arrival"])


def _router(i: Inputs) -> DataFrame:
    routed = ingest.with_table(feeds.envelope(i.spark, i.sf_dir))
    event_id = "get_json_object(cast(value AS string), '$.event_id')"
    return routed.groupBy("table_name").agg(
        *S.exprs("count(1) AS message_count", f"count(DISTINCT {event_id}) AS distinct_ids")
    )


def _keyed_json(i: Inputs) -> DataFrame:
    columns = [f.name for f in STOCK_WIRE if f.name != "timestamp"]
    sent = messages.to_messages(i.raw(feeds.movements_feed).select(columns), STOCK_TOPIC)
    return sent.selectExpr("topic", "cast(key AS string) AS key", "cast(value AS string) AS value")


def _date_parts(i: Inputs) -> DataFrame:
    day = "cast(ts AS date)"
    return i.raw(feeds.deliveries_feed).selectExpr(
        "event_id",
        f"{day} AS day",
        f"{S.week_start(day)} AS week_start",
        f"{S.month_start(day)} AS month_start",
        "weekofyear(ts) AS iso_week",
        "month(ts) AS month",
        "year(ts) AS year",
    )


def _text(i: Inputs) -> DataFrame:
    return i.raw(feeds.movements_feed).selectExpr(
        "event_id",
        f"{S.upper_clean('category')} AS category",
        f"{S.upper_clean('warehouse')} AS warehouse",
        f"{S.lower_clean('event_type')} AS movement_type",
        f"{S.lower_clean('reason')} AS reason",
    )


def _direction(i: Inputs) -> DataFrame:
    return i.raw(feeds.movements_feed).selectExpr(
        "event_id", "delta", f"{S.direction('delta')} AS direction", "abs(delta) AS units_moved"
    )


_SKU_DAY = ("snapshot_date", "sku", "category")

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "stg_sales": Inputs.sales,
    "stg_stock_movements": Inputs.moves,
    "fct_inventory_snapshot": Inputs.snapshot,
    "fct_sales_velocity": lambda i: reports.shown(
        "fct_sales_velocity", marts.sales_velocity(i.sales(), i.snapshot())
    ),
    "mv_category_daily_summary": lambda i: reports.shown(
        "mv_category_daily_summary", reports.category_daily_summary(i.snapshot())
    ),
    "category_summary_by_changes": lambda i: change_points.category_daily_summary(
        i.sales(), i.moves(), START, AS_OF
    ),
    "mv_sku_reorder_watchlist": lambda i: reports.shown("mv_sku_reorder_watchlist", i.watchlist()),
    "mv_channel_revenue_weekly": lambda i: reports.shown(
        "mv_channel_revenue_weekly", reports.channel_revenue_weekly(i.sales())
    ),
    "mv_supplier_performance": lambda i: reports.shown(
        "mv_supplier_performance", reports.supplier_performance(i.raw(feeds.deliveries_feed))
    ),
    "vw_daily_kpis": lambda i: reports.daily_kpis(i.watchlist(), i.sales(), AS_OF),
    "reorder_alerts": Inputs.alerts,
    "reorder_alerts_ignore": lambda i: i.alerts("ignore"),
    "reorder_alerts_events": lambda i: alerts.reorder_alerts(i.stock_events(), ["arrival"], NOW),
    "reorder_alerts_streamed": _streamed_alerts,
    "ingest_raw_sales": lambda i: _stored_raw(i, "raw_sales"),
    "ingest_raw_movements": lambda i: _stored_raw(i, "raw_stock_movements"),
    "ingest_raw_deliveries": lambda i: _stored_raw(i, "raw_supplier_deliveries"),
    "ingest_dead_letters": _stored_dead_letters,
    "stored_stg_sales": lambda i: _stored_table(i, "stg_sales"),
    "stored_stg_stock_movements": lambda i: _stored_table(i, "stg_stock_movements"),
    "stored_channel_revenue": lambda i: _stored_report(i, "mv_channel_revenue_weekly"),
    "stored_supplier_performance": lambda i: _stored_report(i, "mv_supplier_performance"),
    "stored_schema_sync": _stored_schema_sync,
    "stored_rejected_sales": _rejected,
    "supplier_performance_bulk": lambda i: reports.supplier_performance(_bulk(i, feeds.deliveries_feed, "unit_cost")),
    "hourly_incremental": lambda i: _hourly(i, "incremental", "fct_inventory_snapshot"),
    "hourly_incremental_velocity": lambda i: _hourly(i, "incremental", "fct_sales_velocity"),
    "hourly_incremental_summary": lambda i: _hourly(i, "incremental", "mv_category_daily_summary"),
    "hourly_incremental_watchlist": lambda i: _hourly(i, "incremental", "mv_sku_reorder_watchlist"),
    "hourly_full": lambda i: _hourly(i, "full", "fct_inventory_snapshot"),
    "dispatch_payload": lambda i: alerts.dispatch_payload(i.alerts()),
    "date_spine": _sales_calendar,
    "sku_dimension": lambda i: daily.sku_dimension(i.sales(), i.moves()),
    "sku_date_spine": lambda i: daily.sku_date_spine(
        daily.sku_dimension(i.sales(), i.moves()), START, AS_OF
    ),
    "daily_movements": lambda i: daily.daily_movements(i.moves()),
    "daily_sales_outflow": lambda i: daily.daily_sales_outflow(i.sales()),
    "spine_activity_joins": _spine_joins,
    "running_stock": lambda i: windows.with_running_stock(i.activity()).select(
        *_SKU_DAY, "running_stock"
    ),
    "rolling_velocity": _rolling,
    "weekly_open_close": lambda i: windows.weekly_open_close(i.snapshot()),
    "weekly_sales": lambda i: marts.weekly_sales(i.sales()),
    "wow_delta": _weekly,
    "latest_per_sku": lambda i: windows.latest_per_sku(i.snapshot()),
    "conditional_counts": lambda i: reports.category_daily_summary(i.snapshot()).select(
        "snapshot_date", "category", "reorder_skus", "overstock_skus"
    ),
    "on_time_rate": lambda i: reports.supplier_performance(i.raw(feeds.deliveries_feed)).select(
        "supplier_id", "month", "on_time_pct"
    ),
    "lead_variance": lambda i: reports.supplier_performance(i.raw(feeds.deliveries_feed)).select(
        "supplier_id", "month", "avg_lead_variance_days"
    ),
    "fill_rate": lambda i: reports.daily_kpis(i.watchlist(), i.sales(), AS_OF).select(
        "fill_rate_pct"
    ),
    "top_alerts": lambda i: alerts.top_alerts(i.alerts()),
    "current_stock": lambda i: daily.current_stock(i.raw(feeds.movements_feed)),
    "dedup_first_wins": lambda i: i.raw(feeds.sales_feed),
    "dedup_supplier_deliveries": lambda i: i.raw(feeds.deliveries_feed),
    "dedup_stock_movements": lambda i: i.raw(feeds.movements_feed),
    "anti_join_unseen": _unseen,
    "incremental_upsert": _upsert,
    "schema_sync": _schema_sync,
    "incremental_slice": lambda i: staging.newer_than(i.raw(feeds.movements_feed), MARK),
    "high_water_mark": lambda i: i.raw(feeds.sales_feed).agg(F.max("ingested_at").alias("mark")),
    "freshness_report": _freshness,
    "uniqueness_report": lambda i: quality.uniqueness_report(
        i.feed(feeds.sales_feed), ["event_id"]
    ),
    "model_tests_staging": _staging_tests,
    "model_tests_marts": _mart_tests,
    "threshold_lookup": lambda i: alerts.with_threshold(
        feeds.envelope_events(i.spark, i.sf_dir).select("arrival", "category")
    ).select("arrival", "category", "threshold"),
    "json_roundtrip": _roundtrip,
    "topic_router": _router,
    "keyed_json": _keyed_json,
    "urgency_tier": lambda i: i.snapshot().selectExpr(
        *_SKU_DAY, f"{S.urgency_tier('stock_on_hand', 'days_on_hand')} AS stock_status"
    ),
    "reorder_qty": lambda i: i.snapshot().selectExpr(
        *_SKU_DAY, f"{S.reorder_quantity('velocity_30d', 'stock_on_hand')} AS suggested_reorder_qty"
    ),
    "direction_label": _direction,
    "revenue": lambda i: i.sales().select("event_id", "gross_revenue", "net_revenue"),
    "date_parts": _date_parts,
    "text_normalise": _text,
}


def registered() -> dict[str, Query]:
    """Query name -> callable of (spark, data folder)."""

    def bind(build: Callable[[Inputs], DataFrame]) -> Query:
        return lambda spark, sf_dir: build(Inputs(spark, sf_dir))

    return {name: bind(build) for name, build in _QUERIES.items()}
