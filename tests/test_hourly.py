from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stockflow.operators import staging
from stockflow.operators.quality import QualityError
from stockflow.plans import hourly, marts, reports, staging_tables
from stockflow.sources import parts, tables
from stockflow.sources.commits import Conflict
from stockflow.streaming.ingest import ingest_batch
from tests.rows import T0, at, day, listed, raw_sales
from tests.test_ingest import envelope, sale, stock, supply

HOUR = dt.timedelta(hours=1)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.select(a.columns).exceptAll(a).count() == 0


def refresh(raw, root, **more):
    return staging_tables.refresh(raw, staging.stg_sales, root, "stg_sales", **more)


def late_and_repeated(spark):
    """Thirty rows over five days; ingest order is unrelated to the day."""
    rows = [{"event_id": f"e{i}", "ts": at(i % 5), "ingested_at": T0 + i * HOUR, "quantity": i + 1} for i in range(30)]
    return raw_sales(spark, *rows)


@pytest.mark.parametrize("days_fixed", [True, False])
def test_slices_equal_a_full_refresh(spark, tmp_path, days_fixed):
    raw, root = late_and_repeated(spark), str(tmp_path)
    for hours in (9, 10, 17, 17, 40):
        part = raw.filter(F.col("ingested_at") <= T0 + hours * HOUR)
        got = refresh(part, root, days_fixed=days_fixed, overlap=2 * HOUR)
    assert same(got, staging.stg_sales(raw))
    assert same(refresh(raw, root, mode="full"), got)
    assert len(tables.numbered(spark, f"{root}/stg_sales", "version")) == 2


def test_newer_version_moves_to_another_day(spark, tmp_path):
    root = str(tmp_path)
    refresh(raw_sales(spark, {"event_id": "a"}, {"event_id": "b", "ts": at(1)}), root)
    newer = raw_sales(spark, {"event_id": "b", "ts": at(2), "quantity": 7, "ingested_at": T0 + HOUR})
    got = refresh(newer, root)
    assert listed(got, "event_id", "quantity", "event_date") == [("a", 1, day(0)), ("b", 7, day(2))]


def test_empty_target_takes_everything(spark, tmp_path):
    root = str(tmp_path)
    assert refresh(raw_sales(spark), root).count() == 0
    assert tables.read_current(spark, root, "stg_sales").count() == 0
    assert refresh(raw_sales(spark, {}), root).count() == 1


def test_equal_mark_needs_overlap(spark, tmp_path):
    root = str(tmp_path)
    refresh(raw_sales(spark, {}), root)
    raw = raw_sales(spark, {}, {})
    assert refresh(raw, root).count() == 1
    assert refresh(raw, root, overlap=dt.timedelta(microseconds=1)).count() == 2


def test_interrupted_apply_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    raw = late_and_repeated(spark)
    refresh(raw.filter(F.col("ingested_at") <= T0 + 9 * HOUR), root)
    apply = staging_tables._apply_pending
    calls = []

    def stop_at_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        apply(*args)

    monkeypatch.setattr(staging_tables, "_apply_pending", stop_at_second)
    with pytest.raises(RuntimeError):
        refresh(raw.filter(F.col("ingested_at") <= T0 + 20 * HOUR), root)
    monkeypatch.undo()
    assert same(refresh(raw, root), staging.stg_sales(raw))


def test_changed_columns(spark, tmp_path):
    root = str(tmp_path)
    refresh(raw_sales(spark, {"event_id": "a"}), root)

    def build(raw):
        return staging.stg_sales(raw).drop("color").withColumn("added", F.lit(1))

    newer = raw_sales(spark, {"event_id": "b", "ingested_at": T0 + HOUR})
    got = staging_tables.refresh(newer, build, root, "stg_sales")
    assert "color" not in got.columns
    assert listed(got, "event_id", "added") == [("a", None), ("b", 1)]


def test_unknown_day(spark, tmp_path):
    root = str(tmp_path)
    refresh(raw_sales(spark, {"event_id": "a", "ts": None}, {"event_id": "b"}), root)
    newer = raw_sales(spark, {"event_id": "c", "ts": None, "ingested_at": T0 + HOUR})
    assert listed(refresh(newer, root), "event_id", "event_date") == [("a", None), ("b", day(0)), ("c", None)]


def swimwear(event_id, **more):
    return sale(event_id, category="Swimwear", **more)


def test_whole_run(spark, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    now = dt.datetime(2024, 3, 9, 10, 0, 0)
    run = dict(as_of=dt.date(2024, 3, 9), start=dt.date(2024, 3, 1))
    first = envelope(
        spark, stock("m1", 5), stock("m2", 50, sku="B"), swimwear("s1", quantity=2),
        swimwear("s2", sku="B", timestamp="2024-03-05T09:00:00+00:00"), supply("d1", actual_date="2024-03-10"),
    )
    ingest_batch(first, root, 0, now - HOUR, ["arrival"])
    out = hourly.run_hourly(spark, root, now=now, **run)
    assert out["fct_inventory_snapshot"].count() == 2 * 9
    assert listed(out["mv_sku_reorder_watchlist"], "sku", "stock_on_hand") == [("A", 3), ("B", 49)]
    assert listed(out["mv_supplier_performance"], "supplier_id", "on_time_pct") == [("SUP-1", Decimal("0.0"))]
    payload = json.loads(out["alert_payload"].first().payload)
    assert [(p["sku"], p["current_stock"]) for p in payload] == [("A", 5)]
    kpis = out["vw_daily_kpis"].first()
    assert (kpis.total_units_on_hand, kpis.units_sold_today) == (52, 2)

    # A later hour: a late sale and a repeat. Incremental equals a rebuild.
    late = envelope(
        spark, swimwear("s3", quantity=4, timestamp="2024-03-02T09:00:00+00:00"), swimwear("s1", quantity=99),
        stock("m3", 1), supply("d2"), first=50,
    )
    ingest_batch(late, root, 1, now, ["arrival"])
    out = hourly.run_hourly(spark, root, now=now + HOUR / 2, **run)
    kept = {n: df.toPandas() for n, df in out.items() if n in ("stg_sales", "fct_sales_velocity")}
    assert sorted(kept["stg_sales"].event_id) == ["s1", "s2", "s3"]
    full = hourly.run_hourly(spark, root, now=now + HOUR / 2, mode="full", **run)
    for name, frame in kept.items():
        order = sorted(frame.columns)
        again = full[name].toPandas()[order].sort_values(order[:6]).reset_index(drop=True)
        assert frame[order].sort_values(order[:6]).reset_index(drop=True).equals(again)
    assert same(
        full["fct_inventory_snapshot"],
        marts.inventory_snapshot(full["stg_sales"], full["stg_stock_movements"], run["start"], run["as_of"]),
    )

    with pytest.raises(QualityError, match="raw_sales.*raw_stock_movements.*raw_supplier"):
        hourly.run_hourly(spark, root, now=now + 5 * HOUR, **run)
    with pytest.raises(ValueError, match="mode"):
        refresh(raw_sales(spark, {}), root, mode="other")


def test_increment_reads_new_batches_and_tests_their_days(spark, tmp_path, monkeypatch):
    """Staging by batch number: equal to a rebuild, whatever the clock said, and retried until tested."""
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    now = dt.datetime(2024, 3, 9, 10, 0, 0)
    run = dict(as_of=dt.date(2024, 3, 9), now=now, start=dt.date(2024, 3, 1))
    first = [stock("m1", 5), swimwear("s1"), swimwear("s2", timestamp="2024-03-05T09:00:00+00:00"), supply("d1")]
    ingest_batch(envelope(spark, *first), root, 0, now, ["arrival"])
    hourly.run_hourly(spark, root, **run)
    assert tables.staged_upto(spark, root, "stg_sales") == 0

    # The same batch time as before: a time mark would pass these rows by.
    ingest_batch(envelope(spark, swimwear("s3"), stock("m2"), supply("d2"), first=9), root, 1, now, ["arrival"])
    tested = []

    def stop(models):
        tested.append({n: sorted(r.event_id for r in df.collect()) for n, df in models.items() if n == "stg_sales"})
        raise QualityError("stopped")

    monkeypatch.setattr(hourly, "check", stop)
    for _ in range(2):
        with pytest.raises(QualityError):
            hourly.run_hourly(spark, root, **run)
        assert tables.staged_upto(spark, root, "stg_sales") == 0
    monkeypatch.undo()
    # Only the written day, and again at the second try.
    assert tested == [{"stg_sales": ["s1", "s3"]}] * 2
    out = hourly.run_hourly(spark, root, **run)
    assert tables.staged_upto(spark, root, "stg_sales") == 1
    assert tables.numbered(spark, f"{root}/_staged/stg_sales", "batch_id") == [1]
    for name, (source, clean) in hourly.STAGING.items():
        assert same(out[name], clean(tables.committed(spark, root, source)))


def test_two_categories_stop_the_run(spark, tmp_path):
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    now = dt.datetime(2024, 3, 9, 10, 0, 0)
    batch = envelope(spark, stock("m1"), sale("s1"), sale("s2", category="Denim"), supply("d1"))
    ingest_batch(batch, root, 0, now, ["arrival"])
    with pytest.raises(QualityError, match="unique_snapshot_date_sku"):
        hourly.run_hourly(spark, root, dt.date(2024, 3, 9), now, dt.date(2024, 3, 8))


def test_an_increment_writes_the_days_that_changed(spark, tmp_path):
    """A sale of an open day, a late one, a SKU that is new, a day more: each equals a rebuild."""
    root = str(tmp_path)
    tables.ensure_tables(spark, root)
    run = dict(now=dt.datetime(2024, 3, 9, 10, 0, 0), start=dt.date(2024, 2, 26))

    def on(event_id, when, **more):
        return swimwear(event_id, timestamp=f"2024-{when}T09:00:00+00:00", **more)

    def hour(n, as_of, *events):
        rows = [*events, stock(f"m{n}", 3 + n, timestamp=f"2024-{events[0][1]['timestamp'][5:10]}T08:00:00+00:00"), supply(f"d{n}")]
        ingest_batch(envelope(spark, *rows, first=100 * n), root, n, run["now"], ["arrival"])
        out = hourly.run_hourly(spark, root, as_of=as_of, **run)
        names = ("fct_inventory_snapshot", "fct_sales_velocity", "mv_category_daily_summary", "mv_channel_revenue_weekly")
        versions = {t: parts.newest(spark, root, t).parts for t in names}
        sales, moves = out["stg_sales"], out["stg_stock_movements"]
        want = marts.inventory_snapshot(sales, moves, run["start"], as_of)
        assert same(out["fct_inventory_snapshot"], want)
        assert same(out["fct_sales_velocity"], marts.sales_velocity(sales, want))
        assert same(out["mv_category_daily_summary"], reports.category_daily_summary(want))
        assert same(out["mv_channel_revenue_weekly"], reports.channel_revenue_weekly(sales))
        assert same(out["mv_sku_reorder_watchlist"], reports.reorder_watchlist(want, as_of))
        return versions

    def changed(old, new):
        """Parts whose folders are others now, by table."""
        return {t: sorted(p for p in new[t] if old[t].get(p) != new[t][p]) for t in new}

    last = dt.date(2024, 3, 8)
    v0 = hour(0, last, on("a0", "02-27"), on("a1", "02-28", sku="A", quantity=2), on("a2", "03-05"))
    v1 = hour(1, last, on("b0", "03-07", quantity=3))
    assert changed(v0, v1) == {
        "fct_inventory_snapshot": ["2024-03-07", "2024-03-08"],
        "fct_sales_velocity": ["2024-03-04"],
        "mv_category_daily_summary": ["2024-03-07", "2024-03-08"],
        "mv_channel_revenue_weekly": ["2024-03-04"],
    }
    # A late sale: everything from its day on, but for the channel's week after it.
    v2 = hour(2, last, on("c0", "03-01"))
    found = changed(v1, v2)
    assert min(found["fct_inventory_snapshot"]) == "2024-03-01" and len(found["fct_sales_velocity"]) == 2
    assert found["mv_channel_revenue_weekly"] == ["2024-02-26"]
    # The calendar goes on. A new SKU has rows on every day; the files of earlier days stay and get another.
    v3 = hour(3, last + dt.timedelta(days=1), on("e0", "03-09", sku="NEW"))
    old, new = v2["fct_inventory_snapshot"], v3["fct_inventory_snapshot"]
    assert all(new[d][: len(f)] == f and len(new[d]) == len(f) + 1 for d, f in old.items())
    assert len(new["2024-03-09"]) == 1
    # Two runs that saw the same version: the second finds its number taken.
    before = parts.newest(spark, root, "fct_sales_velocity")
    staged = parts.stage(parts.read(spark, root, "fct_sales_velocity"), root, "fct_sales_velocity", "week_start")
    parts.publish(spark, root, "fct_sales_velocity", staged, before)
    with pytest.raises(Conflict):
        parts.publish(spark, root, "fct_sales_velocity", staged, before)
