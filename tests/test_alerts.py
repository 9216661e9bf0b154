from __future__ import annotations

import datetime as dt
import json
import random

import pytest

from stockflow.operators import alerts
from stockflow.sources.schemas import REORDER_THRESHOLDS
from tests.rows import T0, listed, raw_moves

NOW = dt.datetime(2024, 3, 9, 10, 0, 0)


def feed(spark, *rows):
    """Movements arriving one second apart."""
    return raw_moves(spark, *[{"ingested_at": T0 + dt.timedelta(seconds=i), **r} for i, r in enumerate(rows)])


def raised(spark, *rows, duplicates="realert"):
    got = alerts.reorder_alerts(feed(spark, *rows), ["ingested_at"], NOW, duplicates)
    return listed(got, "current_stock", "threshold")


def test_alert_after_each_low_event(spark):
    rows = [{"delta": d, "category": "Tops"} for d in (60, -15, -15)]
    assert raised(spark, *rows) == [(30, 50), (45, 50)]


def test_category_is_matched_as_spelled(spark):
    assert raised(spark, {"category": "tops", "delta": 19}) == [(19, 20)]
    assert raised(spark, {"category": "tops", "delta": 20}) == []
    assert raised(spark, {"category": None, "delta": 19}) == [(19, 20)]


def test_repeat_is_checked_again_or_ignored(spark):
    rows = [{"event_id": "e1", "category": "Swimwear", "delta": 5}] * 2
    assert raised(spark, *rows) == [(5, 10), (5, 10)]
    assert raised(spark, *rows, duplicates="ignore") == [(5, 10)]


def test_no_alert_at_the_threshold(spark):
    assert raised(spark, {"category": "Swimwear", "delta": 10}) == []


def test_rows_without_sku_or_id(spark):
    assert raised(spark, {"sku": None}, {"event_id": None}) == []
    # A row without SKU still uses up its event id.
    rows = [{"event_id": "e", "sku": None, "delta": 5}, {"event_id": "e", "delta": 5}]
    assert raised(spark, *rows) == [(0, 50)]


def test_alert_row(spark):
    got = alerts.reorder_alerts(feed(spark, {}), ["ingested_at"], NOW).first()
    assert (got.sku, got.category, got.alert_ts, got.resolved) == ("A", "Tops", NOW, False)


def by_hand(rows):
    """The sequential rule: store if new, then compare the SKU's stored sum."""
    seen, stock, out = set(), {}, []
    for r in rows:
        if r["event_id"] not in seen:
            seen.add(r["event_id"])
            stock[r["sku"]] = stock.get(r["sku"], 0) + r["delta"]
        limit = REORDER_THRESHOLDS.get(r["category"], 20)
        if stock.get(r["sku"], 0) < limit:
            out.append((r["sku"], stock.get(r["sku"], 0), limit))
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_hot_sku_split_over_slices(spark, seed):
    rng = random.Random(seed)
    rows = [
        {
            "event_id": f"e{rng.randrange(900)}",
            "sku": "HOT" if rng.random() < 0.7 else rng.choice("ABCD"),
            "category": rng.choice(["Tops", "Denim", "other"]),
            "delta": rng.randrange(-30, 32),
        }
        for _ in range(1200)
    ]
    got = alerts.reorder_alerts(feed(spark, *rows), ["ingested_at"], NOW)
    assert sorted(tuple(r) for r in got.select("sku", "current_stock", "threshold").collect()) == by_hand(rows)


def test_hot_event_copies_are_split(spark):
    # 3,000 identical copies: one counts, all are checked.
    copies = raw_moves(spark, {"event_id": "e", "delta": 7}).crossJoin(spark.range(3000).select())
    running = alerts.running_stock(copies, copies.limit(1), ["ingested_at"])
    assert running.groupBy("current_stock").count().collect()[0].asDict() == {"current_stock": 7, "count": 3000}


def alert_log(spark, rows):
    return spark.createDataFrame(rows, "sku string, category string, threshold int, current_stock bigint, alert_ts timestamp, resolved boolean")


def test_dispatch(spark):
    log = alert_log(spark, [(f"K{i:02d}", "Tops", 50, i, NOW, False) for i in range(60)]
                    + [("DONE", "Tops", 50, -1, NOW, True)] * 5)
    assert listed(alerts.top_alerts(log), "current_stock") == sorted([(i,) for i in range(50)], key=str)
    got = alerts.dispatch_payload(log).first()
    payload = json.loads(got.payload)
    assert got.alert_count == 50 and [p["current_stock"] for p in payload] == list(range(50))
    assert payload[0] == {
        "sku": "K00", "category": "Tops", "threshold": 50, "current_stock": 0,
        "alert_ts": "2024-03-09 10:00:00+00:00",
    }


def test_dispatch_with_microseconds_and_without_alerts(spark):
    exact = NOW.replace(microsecond=120)
    log = alert_log(spark, [("K", "Tops", 50, 1, exact, False)])
    assert "10:00:00.000120+00:00" in alerts.dispatch_payload(log).first().payload
    assert alerts.dispatch_payload(log.limit(0)).count() == 0
