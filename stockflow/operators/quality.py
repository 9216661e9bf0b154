"""Data-quality reports. Each is a DataFrame; the ``assert_`` helpers read its few rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame

from stockflow.functions.scalars import exprs, instant

FRESH_HOURS = 2


class QualityError(ValueError):
    """One or more data-quality checks failed."""


def freshness_report(tables: Mapping[str, DataFrame], now: dt.datetime) -> DataFrame:
    """Rows ingested strictly less than two hours before ``now``, per table, in one job."""
    since = now - dt.timedelta(hours=FRESH_HOURS)
    counted = [
        df.filter(f"ingested_at > {instant(since)}").agg(
            *exprs(f"'{name}' AS table_name", "count(1) AS fresh_rows")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted).selectExpr("*", "fresh_rows >= 1 AS ok")


def assert_fresh(report: DataFrame) -> None:
    """Raise once, naming every table without fresh rows."""
    stale = report.filter("NOT ok").orderBy("table_name").collect()
    if stale:
        raise QualityError(
            "stale tables: "
            + "; ".join(f"{r.table_name} has {r.fresh_rows} fresh rows" for r in stale)
        )


def uniqueness_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(*exprs("count(1) AS row_count")).filter("row_count > 1")


#: model -> (unique key, columns never NULL, row conditions that must hold)
MODEL_RULES: dict[str, tuple[list[str], list[str], dict[str, str]]] = {
    "stg_sales": (
        ["event_id"],
        ["event_id", "sku"],
        {"quantity_positive": "quantity > 0", "unit_price_positive": "unit_price > 0"},
    ),
    "stg_stock_movements": (
        ["event_id"],
        ["event_id", "sku"],
        {"stock_delta_not_zero": "stock_delta <> 0"},
    ),
    "fct_inventory_snapshot": (
        ["snapshot_date", "sku"],
        ["snapshot_date", "sku"],
        {"flags_exclusive": "NOT (is_reorder_required AND is_overstock)"},
    ),
    "fct_sales_velocity": (
        ["week_start", "category", "channel", "sku"],
        ["week_start", "sku"],
        {"units_positive": "units_sold > 0"},
    ),
}


def model_report(name: str, df: DataFrame) -> DataFrame:
    """Failing rows of every test on a model: one pass for row tests, one for uniqueness."""
    keys, required, conditions = MODEL_RULES[name]
    holds = {f"not_null_{c}": f"{c} IS NOT NULL" for c in required} | conditions
    # A NULL condition is a failure too.
    row_tests = df.agg(
        *exprs(*[f"count(CASE WHEN ({rule}) IS NOT TRUE THEN 1 END) AS {t}" for t, rule in holds.items()])
    )
    unpivoted = row_tests.unpivot([], list(holds), "test", "failing")
    repeated = uniqueness_report(df, keys).agg(
        *exprs(f"'unique_{'_'.join(keys)}' AS test", "count(1) AS failing")
    )
    return unpivoted.unionByName(repeated).selectExpr(f"'{name}' AS model", "test", "failing")


def assert_models(report: DataFrame) -> None:
    failed = report.filter("failing > 0").orderBy("model", "test").collect()
    if failed:
        raise QualityError(
            "model tests failed: "
            + "; ".join(f"{r.model}.{r.test} on {r.failing}" for r in failed)
        )
