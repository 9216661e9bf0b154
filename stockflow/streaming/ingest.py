"""Micro-batch ingest: route, de-duplicate, store, and raise low-stock alerts.

The ids that a stream has seen are its own state, kept by key in RocksDB: a batch looks up its own
ids, whatever the number of rows stored before. Rows that other streams stored are told to that
state as a further source, read once when the stream starts.

A batch writes folders that nobody reads and then adds one commit that names them all. A replay of a
stored batch does nothing; one that was lost half way leaves folders without a name. Delivery is at
least once, and each event, and each dead letter, is stored once.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import replace
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stockflow.functions.scalars import exprs, instant
from stockflow.operators import alerts
from stockflow.operators.dedup import first_wins, unseen
from stockflow.session import pin_session
from stockflow.sources import commits, tables
from stockflow.sources import messages as M
from stockflow.sources.commits import Commit, Conflict
from stockflow.sources.messages import DEAD_LETTERS
from stockflow.sources.schemas import KEY_OF, REORDER_THRESHOLDS, ROUTES, SKU_STOCK, STOCK_TOPIC

#: Arrival order of Kafka records, as the broker has it: records of one SKU share a partition, and
#: a producer's time need not rise with the offset.
KAFKA_ARRIVAL = ("partition", "offset")
#: Folders of one level of the stock log before they become one of the next.
STOCK_FAN = 8

_ID = ["table_name", "row_id"]
_SEEDS = "table_name string, row_id string"
#: Stands among the seeds for "all batches up to row_id are told".
_TOLD = "_told"
_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state."
    "RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def with_table(messages: DataFrame) -> DataFrame:
    """Add the table each message is routed to; unknown topics go to the dead letters."""
    cases = " ".join(f"WHEN '{topic}' THEN '{table}'" for topic, (table, _) in ROUTES.items())
    return messages.selectExpr("*", f"CASE topic {cases} ELSE '{DEAD_LETTERS}' END AS table_name")


def _utc(at: dt.datetime) -> dt.datetime:
    return at.replace(tzinfo=dt.timezone.utc) if at.tzinfo is None else at


def _envelope(messages: DataFrame, arrival: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The columns ingest works on; the envelope's own time must not clash with the payload's."""
    kept = [f"arrival_{i}" for i in range(len(arrival))]
    renamed = [f"{c} AS {k}" for c, k in zip(arrival, kept, strict=True)]
    return M.route(messages.selectExpr("topic", "key", "value", *renamed), kept), kept


def _claimed(spark: SparkSession, root: str, state: Commit, stream: str, number: int, now: dt.datetime) -> dt.datetime:
    """The batch's time: the one it had at its first try. Times of batches never fall."""
    claim = f"{root}/_claims/{state.batch + 1}"
    if commits.exists(spark, claim):
        held = json.loads(commits.read_text(spark, claim))
        if (held["stream"], held["stream_batch"]) == (stream, number):
            return dt.datetime.fromisoformat(held["at"])
    if state.at is not None:
        latest = dt.datetime.fromisoformat(state.at)
        if _utc(now) < latest:
            now = latest + dt.timedelta(microseconds=1)
    text = json.dumps({"stream": stream, "stream_batch": number, "at": now.isoformat()})
    commits.write_text(spark, claim, text)
    return now


Land = Callable[..., DataFrame]


@contextmanager
def _landing(spark: SparkSession, root: str) -> Iterator[Land]:
    """A function that writes rows to a folder of their own, by columns if any, and reads them back.

    Rows that several jobs read are computed once. Those jobs read the columns and folders they need
    and carry nothing of the plan that made the rows: over a cached batch each of their tasks would
    report every metric of the stream's state to the driver. Reads are in ``spark``, whose joins and
    shuffles follow measured sizes; the session of a batch of a stream with state has that turned off.
    """
    folder = f"{root}/_incoming/{uuid.uuid4().hex}"

    def land(rows: DataFrame, *by: str) -> DataFrame:
        path = f"{folder}/{uuid.uuid4().hex}"
        rows.write.partitionBy(*by).parquet(path)
        return spark.read.schema(rows.schema).parquet(path).select(rows.columns)

    try:
        yield land
    finally:
        commits.delete(spark, folder)


def _slim(routed: DataFrame) -> DataFrame:
    """Routed messages without what nobody reads: the text of good ones, the event of others."""
    events = {table: F.expr(f"CASE WHEN reason IS NULL THEN {table} END") for table, _ in ROUTES.values()}
    texts = {c: F.expr(f"CASE WHEN reason IS NOT NULL THEN {c} END") for c in ("key", "value")}
    return routed.withColumns({**events, **texts})


def ingest_batch(
    messages: DataFrame,
    root: str,
    stream_batch: int,
    now: dt.datetime,
    arrival: Sequence[str] = KAFKA_ARRIVAL,
    duplicates: str = "realert",
    thresholds: Mapping[str, int] = REORDER_THRESHOLDS,
    stream: str = "batch",
) -> None:
    """Store batch ``stream_batch`` of ``stream``: (topic, key, value, arrival...) messages.

    There is no state of seen ids here, so the batch meets the ids of all stored rows.
    """
    spark = pin_session(messages.sparkSession)
    batch, kept = _envelope(messages, arrival)
    with _landing(spark, root) as land:
        landed = land(_slim(batch), "table_name")
        _store(landed, None, root, stream_batch, now, kept, duplicates, thresholds, stream, None)


def _store(
    batch: DataFrame,
    new: DataFrame | None,
    root: str,
    stream_batch: int,
    now: dt.datetime,
    kept: Sequence[str],
    duplicates: str,
    thresholds: Mapping[str, int],
    stream: str,
    writer: str | None,
) -> None:
    """Store routed messages, landed. ``new`` has the ids that the stream's state had not seen before."""
    spark = pin_session(batch.sparkSession)
    state = commits.newest(spark, root)
    mine = state.streams.get(stream, {"batch": -1, "here": -1, "told": -1})
    if mine["batch"] >= stream_batch:
        return
    number = state.batch + 1
    now = _claimed(spark, root, state, stream, stream_batch, now)
    folders: dict[str, str] = {}
    stock: list[tuple[int, str]] = state.stock
    told = mine["told"]
    present = {r["table_name"] for r in batch.select("table_name").distinct().collect()}
    if new is not None:
        marks = new.filter(F.col("table_name") == _TOLD).agg(F.max(F.col("row_id").cast("long"))).first()[0]
        told = max(told, -1 if marks is None else marks)

    def fresh_rows(first: DataFrame, rows: DataFrame, table: str, key: str) -> DataFrame:
        """Rows of the batch, one per id, whose id no stored row has; ``rows`` has the ids as well."""
        if new is not None:
            ids = new.filter(F.col("table_name") == table).select(F.col("row_id").alias(key))
            # First rows lie by id already. Files do not tell how large the ids are that they hold packed.
            first = first.join(ids.hint("merge"), key, "left_semi")
        stored = _untold(spark, root, state, table, mine["told"], None if new is None else stream)
        return first if stored is None else unseen(first, stored, key, rows.select(F.col("row_id").alias(key)))

    def store(table: str) -> list[tuple[int, str]] | None:
        key, rows = KEY_OF[table], batch.filter(F.col("table_name") == table)
        if table == DEAD_LETTERS:
            letters = M.rejected(rows, now).dropDuplicates([key])
            folders[table] = tables.write_batch(fresh_rows(letters, rows, table, key), root, table, number)
            return None
        topic, wire = next((t, w) for t, (name, w) in ROUTES.items() if name == table)
        good = M.events(rows, wire, kept, table)
        # Copies of one event are cut down before the join on its id.
        fresh = fresh_rows(first_wins(good, key, kept), rows, table, key)

        def write(fresh: DataFrame) -> str:
            stored = fresh.drop(*kept).selectExpr("*", f"{instant(now)} AS ingested_at")
            return tables.write_batch(stored, root, table, number)

        if topic != STOCK_TOPIC:
            folders[table] = write(fresh)
            return None
        with _landing(spark, root) as land:
            fresh = land(fresh)
            checked = {"realert": good, "ignore": fresh}[duplicates]
            opening = _opening(spark, root, state, checked).persist()
            try:
                folders[table], folders["reorder_alerts"], log = _side_by_side(
                    spark,
                    lambda: write(fresh),
                    lambda: _raise_alerts(checked, fresh, opening, root, number, now, kept, thresholds),
                    lambda: _change_stock(fresh, opening, root, state, number),
                )
            finally:
                opening.unpersist()
            return log

    # The tables share nothing but the landed batch.
    for log in _side_by_side(spark, *[partial(store, t) for t in KEY_OF if t in present]):
        stock = log or stock

    def change(last: Commit) -> Commit:
        if last.batch != state.batch or (writer is not None and last.writer != writer):
            raise Conflict(f"another stream writes to {root} now")
        live = {**last.live}
        for table, folder in folders.items():
            live[table] = [*live.get(table, []), (number, folder)]
        streams = {**last.streams, stream: {"batch": stream_batch, "here": number, "told": told}}
        # What an earlier batch merged away no reader has listed lately.
        retired = [f for f in last.retired if not f.startswith("sku_stock/")]
        retired += [folder for level, folder in state.stock if (level, folder) not in stock]
        at = _utc(now).isoformat()
        return replace(
            last, batch=number, at=at, streams=streams, live=live, stock=stock, retired=retired
        )

    after = commits.commit(spark, root, change)
    for folder in [f for f in state.retired if f.startswith("sku_stock/") and f not in after.retired]:
        commits.delete(spark, f"{root}/{folder}")
    commits.delete(spark, f"{root}/_claims/{number}")


def _side_by_side(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """The results of jobs that run at the same time."""
    if not jobs:
        return []
    with ThreadPoolExecutor(len(jobs)) as lanes:
        return list(lanes.map(inheritable_thread_target(spark)(lambda job: job()), jobs))


def _untold(
    spark: SparkSession, root: str, state: Commit, table: str, told: int, stream: str | None
) -> DataFrame | None:
    """Stored rows that the state of ``stream`` may lack, None if it has all.

    Its own batches are in its state, and others up to ``told``. Without a state all rows count.
    """
    if stream is None:
        return tables.read_batches(spark, root, table, state=state)
    others = [known["here"] for name, known in state.streams.items() if name != stream]
    if max(others, default=-1) <= told:
        return None
    return tables.read_batches(spark, root, table, after=told, state=state)


def sku_stock(spark: SparkSession, root: str, state: Commit | None = None) -> DataFrame:
    """(sku, stock) after the last committed batch: of each SKU the newest entry of the log."""
    state = commits.newest(spark, root) if state is None else state
    return _newest_stock(_stock_log(spark, root, state.stock)).select("sku", "stock")


def _stock_log(spark: SparkSession, root: str, log: Sequence[tuple[int, str]]) -> DataFrame:
    if not log:
        return spark.createDataFrame([], SKU_STOCK)
    return spark.read.schema(SKU_STOCK).parquet(*[f"{root}/{folder}" for _, folder in log])


def _newest_stock(log: DataFrame) -> DataFrame:
    return log.groupBy("sku").agg(
        *exprs("max_by(stock, as_of_batch) AS stock", "max(as_of_batch) AS as_of_batch")
    )


def _opening(spark: SparkSession, root: str, state: Commit, checked: DataFrame) -> DataFrame:
    """(sku, stock) before the batch, of the SKUs it names."""
    skus = checked.filter("sku IS NOT NULL").select("sku").distinct()
    known = _stock_log(spark, root, state.stock).join(skus, "sku", "left_semi")
    return _newest_stock(known).select("sku", "stock")


def _raise_alerts(
    checked: DataFrame,
    fresh: DataFrame,
    opening: DataFrame,
    root: str,
    number: int,
    now: dt.datetime,
    arrival: Sequence[str],
    thresholds: Mapping[str, int],
) -> str:
    """Write the alerts of the batch."""
    running = alerts.running_stock(checked, fresh, arrival, opening)
    return tables.write_batch(alerts.alert_rows(running, now, thresholds), root, "reorder_alerts", number)


def _change_stock(
    fresh: DataFrame, opening: DataFrame, root: str, state: Commit, number: int
) -> list[tuple[int, str]]:
    """The stock log with the SKUs that the batch changed, written."""
    change = fresh.filter("sku IS NOT NULL").groupBy("sku").agg(
        *exprs("coalesce(sum(cast(delta AS bigint)), 0L) AS change")
    )
    closing = change.join(opening, "sku", "left").selectExpr(
        "sku", "change + coalesce(stock, 0L) AS stock", f"{number}L AS as_of_batch"
    )
    folder = f"sku_stock/{uuid.uuid4().hex}"
    closing.write.parquet(f"{root}/{folder}")
    return _folded(fresh.sparkSession, root, [*state.stock, (0, folder)])


def _folded(spark: SparkSession, root: str, log: list[tuple[int, str]]) -> list[tuple[int, str]]:
    """The log with ``STOCK_FAN`` folders of a level merged into one of the next, newest entry first.

    A row is written again once a level, so batches cost what they change and a reader opens few
    folders, in the logarithm of the number of batches.
    """
    log = [tuple(entry) for entry in log]
    level = 0
    while len(same := [entry for entry in log if entry[0] == level]) >= STOCK_FAN:
        folder = f"sku_stock/{uuid.uuid4().hex}"
        _newest_stock(_stock_log(spark, root, same)).write.parquet(f"{root}/{folder}")
        log = [entry for entry in log if entry[0] != level] + [(level + 1, folder)]
        level += 1
    return log


def utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _tell(spark: SparkSession, root: str, checkpoint: str, folder: str) -> None:
    """Write the ids of rows that the stream of ``checkpoint`` has not been told of to ``folder``."""
    state = commits.newest(spark, root)
    metadata = f"{checkpoint}/metadata"
    name = json.loads(commits.read_text(spark, metadata))["id"] if commits.exists(spark, metadata) else None
    told = state.streams.get(name, {"told": -1})["told"]
    fs, path = commits._folder(spark, folder)
    fs.mkdirs(path)
    others = [known["here"] for stream, known in state.streams.items() if stream != name]
    if max(others, default=-1) <= told:
        return
    ids = spark.createDataFrame([(_TOLD, str(state.batch))], _SEEDS)
    for table, key in KEY_OF.items():
        stored = tables.read_batches(spark, root, table, after=told, state=state)
        ids = ids.unionByName(stored.selectExpr(f"'{table}' AS table_name", f"{key} AS row_id"))
    ids.write.mode("append").parquet(folder)


def start_ingest(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    arrival: Sequence[str] = KAFKA_ARRIVAL,
    duplicates: str = "realert",
    thresholds: Mapping[str, int] = REORDER_THRESHOLDS,
    clock: Callable[[], dt.datetime] = utc_now,
    every: str | None = None,
) -> StreamingQuery:
    """Run ingest over a stream: every ``every``, or once over what is available.

    Source offsets are committed in ``checkpoint`` only after the batch's tables are. One stream
    writes to a root at a time: the last one started holds it, and a batch of an earlier one finds
    that out when it commits, whenever it began, and fails.
    """
    spark = pin_session(stream.sparkSession)
    tables.ensure_tables(spark, root)
    token = uuid.uuid4().hex
    commits.commit(spark, root, lambda last: replace(last, writer=token))
    seeds = f"{root}/_seeds/{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}"
    _tell(spark, root, checkpoint, seeds)

    routed, kept = _envelope(stream, arrival)
    told = spark.readStream.schema(_SEEDS).parquet(seeds)
    # Which of the ids are new is the state's answer; the messages themselves pass by it.
    new = routed.select(*_ID).unionByName(told).dropDuplicates(_ID).withColumn("is_new", F.lit(True))
    both = _slim(routed).withColumn("is_new", F.lit(False)).unionByName(new, allowMissingColumns=True)

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        # The id is kept in the checkpoint and survives restarts.
        name = session.sparkContext.getLocalProperty("sql.streaming.queryId") or checkpoint
        with _landing(spark, root) as land:
            # The state sees the batch here, once, and again if it was stored but not reported back.
            batch = land(batch, "is_new", "table_name")
            messages, ids = batch.filter("NOT is_new").drop("is_new"), batch.filter("is_new").select(*_ID)
            _store(messages, ids, root, number, clock(), kept, duplicates, thresholds, name, token)

    writer = both.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    before = {key: spark.conf.get(key, None) for key in _STATE_SETTINGS}
    try:
        for key, value in _STATE_SETTINGS.items():
            spark.conf.set(key, value)
        return writer.trigger(**trigger).start()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
