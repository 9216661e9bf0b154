"""The store of ingested tables: commits, seen ids, stock log, compaction, rejected rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest

from stockflow.plans import hourly
from stockflow.sources import commits, messages, tables
from stockflow.sources.commits import Conflict
from stockflow.streaming import ingest
from stockflow.streaming.ingest import ingest_batch, sku_stock, start_ingest
from tests.rows import listed
from tests.test_ingest import ENVELOPE, NOW, envelope, sale, stock, stored, supply


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "tables")
    tables.ensure_tables(spark, path)
    return path


def run_stream(spark, tmp_path, root, checkpoint):
    stream = messages.file_stream(spark, str(tmp_path / "source"), ENVELOPE, 1)
    start_ingest(stream, root, str(tmp_path / checkpoint), ["arrival"], clock=lambda: NOW).awaitTermination()


def send(spark, tmp_path, *events, first=0):
    envelope(spark, *events, first=first).coalesce(1).write.mode("append").parquet(str(tmp_path / "source"))


def test_one_of_two_racing_commits_looks_again(spark, root):
    seen = []

    def change(last):
        if not seen:
            # Another writer comes first.
            commits.commit(spark, root, lambda c: commits.replace(c, writer="other"))
        seen.append(last.number)
        return commits.replace(last, at="2024-01-01T00:00:00+00:00")

    after = commits.commit(spark, root, change)
    assert seen == [0, 1] and (after.number, after.writer) == (2, "other")
    assert not commits.create(spark, f"{root}/_commits/2", "{}")
    assert commits.newest(spark, root) == after


def test_a_batch_of_a_stream_that_lost_the_store_fails_at_its_commit(spark, root, monkeypatch):
    """The second stream takes the store while a batch of the first is being written."""
    commits.commit(spark, root, lambda last: commits.replace(last, writer="first"))
    batch, kept = ingest._envelope(envelope(spark, stock("m1", 5), sale("s1")), ["arrival"])
    write = tables.write_batch

    def taken(df, at, name, number):
        folder = write(df, at, name, number)
        if name == "raw_sales":
            commits.commit(spark, root, lambda last: commits.replace(last, writer="second"))
        return folder

    monkeypatch.setattr(tables, "write_batch", taken)
    ids = batch.select("table_name", "row_id")
    with pytest.raises(Conflict, match="another stream"):
        ingest._store(batch, ids, root, 0, NOW, kept, "realert", {}, "first", "first")
    monkeypatch.undo()
    assert tables.last_committed(spark, root) == -1
    assert stored(spark, root, "raw_sales", "event_id") == []
    ingest._store(batch, ids, root, 0, NOW, kept, "realert", {}, "second", "second")
    assert stored(spark, root, "raw_sales", "event_id") == [("s1",)]
    assert listed(sku_stock(spark, root), "sku", "stock") == [("A", 5)]


def test_a_stream_looks_up_its_own_ids_whatever_the_history(spark, tmp_path, root, monkeypatch):
    """Batches with new ids and with repeats of old ones: no stored id is read again."""
    monkeypatch.setattr(ingest, "STOCK_FAN", 3)
    opened = []
    read = tables.read_batches

    def recorded(spark, at, name, *args, **more):
        opened.append(name)
        return read(spark, at, name, *args, **more)

    monkeypatch.setattr(tables, "read_batches", recorded)
    for n in range(5):
        rows = [stock(f"m{n}", 2, sku=f"K{n % 3}"), stock(f"m{n // 2}", 50), sale(f"s{n}"), sale("s0"), ("x", f"odd {n}")]
        send(spark, tmp_path, *rows, first=10 * n)
    run_stream(spark, tmp_path, root, "progress")
    assert opened == []
    state = commits.newest(spark, root)
    assert state.batch == 4 and sorted(level for level, _ in state.stock) == [0, 0, 1]
    monkeypatch.setattr(tables, "read_batches", read)
    assert len(stored(spark, root, "raw_stock_movements", "event_id")) == 5
    assert len(stored(spark, root, "raw_sales", "event_id")) == 5
    assert listed(sku_stock(spark, root), "sku", "stock") == [("K0", 4), ("K1", 4), ("K2", 2)]
    # A batch writes the SKUs that it changed, here one.
    newest = [folder for level, folder in state.stock if level == 0][-1]
    assert spark.read.parquet(f"{root}/{newest}").count() == 1

    # A lost checkpoint reads everything again, another stream's rows included; nothing is stored twice.
    ingest_batch(envelope(spark, sale("s99"), first=500), root, 0, NOW, ["arrival"], stream="other")
    send(spark, tmp_path, sale("s99"), sale("s100"), first=600)
    run_stream(spark, tmp_path, root, "progress-2")
    assert len(stored(spark, root, "raw_sales", "event_id")) == 7
    assert len(stored(spark, root, "dead_letters", "value")) == 5
    # The first checkpoint is used again: it is told what it has not seen.
    send(spark, tmp_path, sale("s100"), sale("s101"), first=700)
    run_stream(spark, tmp_path, root, "progress")
    assert len(stored(spark, root, "raw_sales", "event_id")) == 8
    assert len(stored(spark, root, "dead_letters", "value")) == 5


def test_same_letters_at_other_places_are_others(spark, root):
    ingest_batch(envelope(spark, ("x", "odd"), ("x", "odd")), root, 0, NOW, ["arrival"])
    assert len(stored(spark, root, "dead_letters", "value")) == 2
    ingest_batch(envelope(spark, ("x", "odd"), ("x", "odd"), ("x", "odd")), root, 1, NOW, ["arrival"], stream="again")
    assert len(stored(spark, root, "dead_letters", "value")) == 3


def test_compaction_lists_days_and_changes_nothing(spark, root, monkeypatch):
    monkeypatch.setattr(tables, "RUNS_OF_A_DAY", 2)
    batches = 0

    def add(*days):
        nonlocal batches
        rows = [sale(f"s{batches}-{d}", timestamp=None if d is None else f"2024-03-{d:02d}T09:00:00+00:00") for d in days]
        ingest_batch(envelope(spark, *rows, first=100 * batches), root, batches, NOW, ["arrival"])
        batches += 1

    def folders():
        return [f for runs in tables._manifest(spark, root, commits.newest(spark, root), "raw_sales")["days"].values() for f in runs]

    for days in ((1, 2), (2, 3), (3, None)):
        add(*days)
    before = listed(tables.read_batches(spark, root, "raw_sales"), "event_id", "batch_id", "ingested_at")
    held = tables.committed(spark, root, "raw_sales")
    assert tables.compact(spark, root, "raw_sales")
    assert not tables.compact(spark, root, "raw_sales")
    assert commits.newest(spark, root).live["raw_sales"] == []
    assert len(folders()) == 4
    after = listed(tables.read_batches(spark, root, "raw_sales"), "event_id", "batch_id", "ingested_at")
    assert after == before and held.count() == 6
    # Part of the batches, whether compacted or not.
    add(1, 9)
    assert listed(tables.committed(spark, root, "raw_sales", 1), "event_id") == [("s2-3",), ("s2-None",), ("s3-1",), ("s3-9",)]
    assert listed(tables.committed(spark, root, "raw_sales", upto=0), "event_id") == [("s0-1",), ("s0-2",)]
    assert tables.compact(spark, root, "raw_sales", 1)
    add(1, 9)
    assert tables.compact(spark, root, "raw_sales", 1)
    # Day 1 had two runs and was merged; the others keep theirs, and old batch folders are gone.
    assert sum("day=2024-03-01" in f for f in folders()) == 1 and sum("day=2024-03-09" in f for f in folders()) == 2
    assert commits.names(spark, f"{root}/raw_sales").count("batch_id=0") == 0
    assert tables.committed(spark, root, "raw_sales").count() == 10
    # A replay of a compacted batch, and a repeat of a compacted event.
    add(*())
    ingest_batch(envelope(spark, sale("s0-1"), sale("s0-2")), root, 0, NOW, ["arrival"])
    ingest_batch(envelope(spark, sale("s0-1"), sale("new"), first=900), root, 9, NOW, ["arrival"])
    assert tables.committed(spark, root, "raw_sales").count() == 11


def test_ingest_and_compaction_do_not_disturb_each_other(spark, root, monkeypatch):
    for n in range(2):
        ingest_batch(envelope(spark, sale(f"s{n}"), first=n), root, n, NOW, ["arrival"])
    commit = commits.commit

    def overtaken(spark, at, change):
        monkeypatch.undo()
        ingest_batch(envelope(spark, sale("s2"), first=2), root, 2, NOW, ["arrival"])
        return commit(spark, at, change)

    monkeypatch.setattr(commits, "commit", overtaken)
    assert tables.compact(spark, root, "raw_sales")
    assert stored(spark, root, "raw_sales", "event_id") == [("s0",), ("s1",), ("s2",)]
    assert [n for n, _ in commits.newest(spark, root).live["raw_sales"]] == [2]


def test_sales_out_of_range_are_stored_with_a_reason_and_deliveries_all_count(spark, root):
    run = dict(as_of=dt.date(2024, 3, 9), now=NOW, start=dt.date(2024, 3, 8))
    huge = dict(quantity=2_000_000_000, unit_price=9_999_999_999.99, category="Swimwear")
    first = [sale("ok", category="Swimwear"), sale("huge", **huge), stock("m1"), supply("d1", actual_date="2024-03-09")]
    most = dict(quantity=2_000_000_000, unit_cost=9_999_999_999.99, actual_date="2024-03-11")
    ingest_batch(envelope(spark, *first, supply("d2", **most), supply("d3", **most)), root, 0, NOW, ["arrival"])
    out = hourly.run_hourly(spark, root, **run)
    assert listed(out["stg_sales"], "event_id") == [("ok",)]
    assert listed(out["rejected_sales"], "event_id", "reason") == [("huge", "amount out of range")]
    line = 2_000_000_000 * Decimal("9999999999.99")
    assert listed(out["mv_supplier_performance"], "total_deliveries", "total_cost", "on_time_pct") == [
        (3, 2 * line + Decimal("12.50"), Decimal("33.3"))
    ]
    ingest_batch(envelope(spark, sale("huge2", **huge), stock("m2"), supply("d4"), first=50), root, 1, NOW, ["arrival"])
    for mode in ("incremental", "incremental", "full"):
        out = hourly.run_hourly(spark, root, mode=mode, **run)
        assert listed(out["rejected_sales"], "event_id") == [("huge",), ("huge2",)]
