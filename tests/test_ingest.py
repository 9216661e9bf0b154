from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.operators import alerts
from stockflow.operators.dedup import dedup_within_delay, first_wins
from stockflow.sources import commits, feeds, messages, tables
from stockflow.sources.schemas import SALES_TOPIC, STOCK_TOPIC, STOCK_WIRE, SUPPLIER_TOPIC
from stockflow.streaming import ingest
from stockflow.streaming.ingest import ingest_batch, sku_stock, start_ingest
from tests.rows import listed

NOW = dt.datetime(2024, 3, 9, 10, 0, 0)
SF = "/root/testdata/sf0.001"
ENVELOPE = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("arrival", T.LongType()),
    ]
)


def stock(event_id, delta=5, sku="A", **more):
    event = dict(
        event_id=event_id, event_type="adjustment", timestamp="2024-03-09T09:00:00.123456+05:30",
        sku=sku, category="Swimwear", warehouse="WH-WEST", delta=delta, reason="damage", reference_id="r",
    )
    return STOCK_TOPIC, {**event, **more}


def sale(event_id, **more):
    event = dict(
        event_id=event_id, event_type="sale", timestamp="2024-03-09T09:00:00+00:00", sku="A",
        category="Tops", channel="web", quantity=1, unit_price=1.005, discount_pct=0, size="M",
        color="Navy", transaction_id="t",
    )
    return SALES_TOPIC, {**event, **more}


def supply(event_id, **more):
    event = dict(
        event_id=event_id, event_type="delivery", timestamp="2024-03-09T09:00:00+00:00", sku="A",
        category="Tops", supplier_id="SUP-1", po_number="PO-1", quantity=5, unit_cost=2.5,
        expected_date="2024-03-09", actual_date=None,
    )
    return SUPPLIER_TOPIC, {**event, **more}


def envelope(spark, *events, first=0):
    rows = []
    for i, (topic, body) in enumerate(events):
        text = body if isinstance(body, str) else json.dumps(body)
        rows.append((topic, b"k", text.encode(), NOW, first + i))
    return spark.createDataFrame(rows, ENVELOPE)


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "tables")
    tables.ensure_tables(spark, path)
    return path


def stored(spark, root, name, *columns):
    return listed(tables.committed(spark, root, name), *columns)


def test_decode_and_routing(spark, root):
    batch = envelope(
        spark, sale("s1"), stock("m1"), supply("d1"), ("fashion.pos.returns", {"event_id": "x"}),
        (STOCK_TOPIC, "not json"), stock("bad", delta="abc"), (STOCK_TOPIC, {"sku": "A"}),
        stock("nosku", sku=None),
    )
    ingest_batch(batch, root, 0, NOW, ["arrival"])
    got = tables.committed(spark, root, "raw_sales").first()
    assert (got.event_id, str(got.unit_price), got.ingested_at) == ("s1", "1.01", NOW)
    ts = tables.committed(spark, root, "raw_stock_movements").filter("event_id = 'm1'").first().ts
    assert ts == dt.datetime(2024, 3, 9, 3, 30, 0, 123456)
    assert stored(spark, root, "raw_stock_movements", "event_id") == [("m1",), ("nosku",)]
    assert stored(spark, root, "raw_supplier_deliveries", "event_id", "actual_date") == [("d1", None)]
    assert stored(spark, root, "dead_letters", "topic", "reason") == [
        ("fashion.pos.returns", "no handler for topic"),
        (STOCK_TOPIC, "malformed"), (STOCK_TOPIC, "malformed"), (STOCK_TOPIC, "missing event_id"),
    ]
    assert stored(spark, root, "reorder_alerts", "sku", "current_stock") == [("A", 5)]


def test_first_event_wins_across_batches_and_replays_change_nothing(spark, root):
    one = envelope(spark, stock("m1", 5), stock("m1", 99), stock("m2", 3))
    two = envelope(spark, stock("m2", 50), stock("m3", -4), first=10)
    for batch, n in ((one, 0), (two, 1), (two, 1)):
        ingest_batch(batch, root, n, NOW, ["arrival"])
    assert stored(spark, root, "raw_stock_movements", "event_id", "delta") == [("m1", 5), ("m2", 3), ("m3", -4)]
    # m1 5, repeat 5, m2 8; then repeat of m2 8, m3 4: all below 10.
    assert stored(spark, root, "reorder_alerts", "current_stock") == [(4,), (5,), (5,), (8,), (8,)]
    assert listed(sku_stock(spark, root), "sku", "stock") == [("A", 4)]
    assert len(commits.newest(spark, root).stock) == 2


def test_another_stream_adds_batches_and_overwrites_none(spark, root):
    first = envelope(spark, stock("m1", 5), stock("m2", 3))
    ingest_batch(first, root, 0, NOW, ["arrival"], stream="one")
    again = envelope(spark, stock("m1", 5), stock("m2", 3), stock("m3", -4))
    ingest_batch(again, root, 0, NOW, ["arrival"], stream="two")
    assert stored(spark, root, "raw_stock_movements", "event_id", "delta") == [("m1", 5), ("m2", 3), ("m3", -4)]
    later = NOW + dt.timedelta(hours=1)
    before = tables.committed(spark, root, "reorder_alerts").collect()
    for name in ("one", "two"):
        ingest_batch(again, root, 0, later, ["arrival"], stream=name)
    assert tables.committed(spark, root, "reorder_alerts").collect() == before
    assert tables.last_committed(spark, root) == 1


def test_an_unfinished_batch_keeps_its_time_and_a_clock_never_falls(spark, root, monkeypatch):
    batch = envelope(spark, sale("s1"))

    def lost(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(tables, "write_batch", lost)
        with pytest.raises(RuntimeError):
            ingest_batch(batch, root, 0, NOW, ["arrival"])
    ingest_batch(batch, root, 0, NOW + dt.timedelta(hours=1), ["arrival"])
    assert stored(spark, root, "raw_sales", "event_id", "ingested_at") == [("s1", NOW)]
    ingest_batch(envelope(spark, sale("s2")), root, 1, NOW - dt.timedelta(days=1), ["arrival"])
    got = tables.committed(spark, root, "raw_sales").filter("event_id = 's2'").first()
    assert got.ingested_at == NOW + dt.timedelta(microseconds=1)


def test_what_another_stream_left_unfinished_is_not_read(spark, root, monkeypatch):
    def lost(*_):
        raise RuntimeError("lost driver")

    with monkeypatch.context() as m:
        m.setattr(commits, "commit", lost)
        with pytest.raises(RuntimeError):
            ingest_batch(envelope(spark, sale("s1")), root, 0, NOW, ["arrival"], stream="one")
    ingest_batch(envelope(spark, supply("d1")), root, 0, NOW, ["arrival"], stream="two")
    assert stored(spark, root, "raw_sales", "event_id") == []
    assert stored(spark, root, "raw_supplier_deliveries", "event_id") == [("d1",)]


@pytest.mark.parametrize(
    "text",
    [
        '{0}{0}', '{0} trailing', '{0}, "x": 1', '{0}] [{0}', '[{0}]', '{0},{0}', '{0}}} {{"value": {0}',
        "{{'event_id': 'a'}}",
    ],
)
def test_only_one_object_per_message(spark, root, text):
    body = json.dumps(stock("m1")[1])
    value = text.format(body)
    ingest_batch(envelope(spark, (STOCK_TOPIC, value), (STOCK_TOPIC, f" {body} ")), root, 0, NOW, ["arrival"])
    assert stored(spark, root, "raw_stock_movements", "event_id") == [("m1",)]
    bad = tables.committed(spark, root, "dead_letters").first()
    assert (bad.reason, bytes(bad.raw_value)) == ("malformed", value.encode())


def test_unfinished_batch_is_not_read(spark, root):
    ingest_batch(envelope(spark, stock("m1")), root, 0, NOW, ["arrival"])
    half = tables.committed(spark, root, "raw_stock_movements").withColumn("event_id", F.lit("half"))
    tables.write_batch(half, root, "raw_stock_movements", 1)
    assert stored(spark, root, "raw_stock_movements", "event_id") == [("m1",)]


def test_keyed_json_round_trip(spark):
    df = spark.createDataFrame([("e", "A", 3)], "event_id string, sku string, delta int")
    sent = messages.to_messages(df, STOCK_TOPIC)
    assert bytes(sent.first().key) == b"A"
    good = messages.events(messages.decode(sent, STOCK_WIRE), STOCK_WIRE, ["topic"])
    assert listed(good, "event_id", "sku", "delta", "topic") == [("e", "A", 3, STOCK_TOPIC)]


def test_stream_equals_batch_with_a_restart(spark, tmp_path):
    """Three file batches, a stop after the first, against the batch operators over all events."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("source", "tables", "checkpoint"))
    events = feeds.envelope(spark, SF).cache()
    parts = [(0, 300), (300, 650), (650, 10**9)]

    def add(n):
        low, high = parts[n]
        events.filter(f"arrival >= {low} AND arrival < {high}").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = messages.file_stream(spark, source, ENVELOPE, 1)
        start_ingest(stream, root, checkpoint, ["arrival"], clock=lambda: NOW).awaitTermination()

    add(0)
    run()
    add(1)
    add(2)
    run()
    assert tables.last_committed(spark, root) >= 2

    moved = feeds.envelope_events(spark, SF).withColumnRenamed("msg_id", "event_id")
    stock_events = moved.filter(F.col("topic") == STOCK_TOPIC)
    want = alerts.reorder_alerts(stock_events, ["arrival"], NOW)
    got = tables.committed(spark, root, "reorder_alerts")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    firsts = first_wins(stock_events, "event_id", ["arrival"]).select("event_id", "sku", "delta")
    raw = tables.committed(spark, root, "raw_stock_movements").select("event_id", "sku", "delta")
    assert raw.exceptAll(firsts).count() == 0 and firsts.exceptAll(raw).count() == 0
    sales = moved.filter(F.col("topic") == SALES_TOPIC).select("event_id").distinct().count()
    assert tables.committed(spark, root, "raw_sales").count() == sales
    assert tables.committed(spark, root, "dead_letters").count() == moved.filter("topic = 'fashion.pos.returns'").count()


def test_bounded_streaming_dedup(spark, tmp_path):
    rows = [("a", NOW), ("a", NOW), ("b", NOW)]
    spark.createDataFrame(rows, "event_id string, ts timestamp").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("event_id string, ts timestamp").parquet(str(tmp_path / "in"))
    query = (
        dedup_within_delay(stream, "event_id", "ts", "1 hour")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert listed(spark.read.parquet(str(tmp_path / "out")), "event_id") == [("a",), ("b",)]


def test_a_streamed_batch_is_stored_from_files_of_its_own(spark, tmp_path, monkeypatch):
    """Jobs of a batch plan with measured sizes and carry nothing of the stream's plan."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("source", "tables", "checkpoint"))
    envelope(spark, stock("m1", 5), sale("s1"), sale("s1"), stock("m1", 5), (STOCK_TOPIC, "{")).write.parquet(source)
    store, seen = ingest._store, []

    def looked_at(batch, new, *rest):
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (batch, new)]
        seen.append((batch.sparkSession.conf.get("spark.sql.adaptive.enabled"), plans))
        store(batch, new, *rest)

    monkeypatch.setattr(ingest, "_store", looked_at)
    stream = messages.file_stream(spark, source, ENVELOPE)
    start_ingest(stream, root, checkpoint, ["arrival"], clock=lambda: NOW).awaitTermination()
    [(adaptive, plans)] = seen
    assert adaptive == "true"
    assert all("FileScan parquet" in p and "InMemoryTableScan" not in p and "Dedup" not in p for p in plans)
    assert stored(spark, root, "raw_stock_movements", "event_id") == [("m1",)]
    assert stored(spark, root, "raw_sales", "event_id") == [("s1",)]
    assert tables.committed(spark, root, "dead_letters").count() == 1
    assert commits.names(spark, f"{root}/_incoming") == []


def test_messages_of_one_row_group_are_made_in_many_tasks(spark, tmp_path):
    rows = [(n, dt.datetime(2024, 1, 1, 8), n % 7, "view", 60.0) for n in range(200)]
    kinds = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, kinds).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sent = feeds.envelope(spark, str(tmp_path))
        assert sent.rdd.getNumPartitions() > 1
        assert sent.select("arrival").distinct().count() == sent.count() == 200
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
