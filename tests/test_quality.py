from __future__ import annotations

import datetime as dt

import pytest

from stockflow.operators import quality
from tests.rows import T0, listed, moves, raw_deliveries, raw_moves, raw_sales, sales

HOURS = dt.timedelta(hours=1)


def test_freshness_is_strict_and_reports_all_at_once(spark):
    tables = {
        "edge": raw_sales(spark, {"ingested_at": T0 - 2 * HOURS}),
        "fresh": raw_moves(spark, {"ingested_at": T0 - HOURS}, {"ingested_at": T0}),
        "none": raw_deliveries(spark),
    }
    report = quality.freshness_report(tables, T0)
    assert listed(report, "table_name", "fresh_rows", "ok") == [
        ("edge", 0, False), ("fresh", 2, True), ("none", 0, False),
    ]
    with pytest.raises(quality.QualityError, match="edge.*none"):
        quality.assert_fresh(report)
    quality.assert_fresh(report.filter("ok"))


def test_model_report(spark):
    good = quality.model_report("stg_sales", sales(spark, {}, {}))
    assert good.count() == 5 and good.filter("failing > 0").count() == 0
    quality.assert_models(good)
    bad = quality.model_report("stg_stock_movements", moves(spark, {"event_id": "m"}, {"event_id": "m"}))
    assert listed(bad.filter("failing > 0"), "test", "failing") == [("unique_event_id", 1)]
    with pytest.raises(quality.QualityError, match="unique_event_id"):
        quality.assert_models(bad)
