"""Stored staging tables: full rebuild, or an upsert that rewrites only the days it touches.

Plain Parquet has no transaction over several folders, so an upsert is first written
complete to a pending folder and then applied; an interrupted apply is repeated from there
before anything else is read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from stockflow.functions.scalars import date
from stockflow.operators.staging import high_water_mark, newer_than
from stockflow.operators.upsert import upsert
from stockflow.session import ensure_checkpoint_dir
from stockflow.sources import tables

DAY = "event_date"
KEY = "event_id"


class Refreshed(NamedTuple):
    """A staging table and the days that the refresh wrote; None stands for every day."""

    table: DataFrame
    days: set[dt.date | None] | None

    def touched(self) -> DataFrame:
        """The rows of the written days."""
        return self.table if self.days is None else self.table.filter(_in_days(self.days))


def refresh(
    raw: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    root: str,
    name: str,
    mode: str = "incremental",
    overlap: dt.timedelta | None = None,
    days_fixed: bool = False,
) -> DataFrame:
    """Bring staging table ``name`` up to date with ``raw`` and return it; see ``refresh_days``."""
    return refresh_days(raw, build, root, name, mode, overlap, days_fixed).table


def refresh_days(
    raw: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    root: str,
    name: str,
    mode: str = "incremental",
    overlap: dt.timedelta | None = None,
    days_fixed: bool = False,
    newer: DataFrame | None = None,
) -> Refreshed:
    """Bring staging table ``name`` up to date with ``raw``.

    ``full`` rebuilds it. ``incremental`` cleans the raw rows past the stored high-water mark
    and replaces their older versions. ``days_fixed`` states that an event never changes its
    day, which limits the search for older versions to the days of the new rows; it holds
    when raw keeps each event once. ``newer`` gives the raw rows that the table may lack, where
    the caller knows them without a look at the stored mark. Columns that come or go and types that
    widen are noted beside the table, and only the days of new rows are written; any other change
    of type rebuilds it.
    """
    spark = raw.sparkSession
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode is full or incremental, not {mode}")
    path = tables.current_path(spark, root, name)
    if mode == "full" or path is None:
        # A rewrite left over from an interrupted run belongs to the version replaced here.
        tables.delete(spark, _pending(root, name))
        return Refreshed(tables.rebuild(build(raw), root, name, [DAY]), None)
    _apply_pending(spark, root, name)
    target = tables.read_version(spark, path)
    if target.isEmpty():
        return Refreshed(tables.rebuild(build(raw), root, name, [DAY]), None)
    new = build(newer_than(raw, high_water_mark(target), overlap) if newer is None else newer)
    changed = _fields(target) != _fields(new)
    if changed and not tables.readable_as(spark, path, new.schema):
        # Files of the old type cannot be read as the new one.
        merged = upsert(target, new, KEY).select(new.columns)
        return Refreshed(tables.rebuild(merged, root, name, [DAY]), None)
    if changed:
        target = spark.read.schema(new.schema).parquet(path).select(new.columns)
    days = _prepare(target, new, root, name, days_fixed)
    if changed:
        # Before the days are replaced: until then a reader finds all files in the old schema.
        tables.log_schema(spark, path, new.schema)
    _apply_pending(spark, root, name)
    rows = spark.read.schema(target.schema).parquet(path).select(new.columns)
    # The rules may name a column that older rows lack, so a new schema is tested on every day.
    return Refreshed(rows, None if changed else days)


def _fields(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)


def _pending(root: str, name: str) -> str:
    return f"{root}/_pending/{name}"


def _in_days(days: Iterable[dt.date | None]) -> str:
    known = ", ".join(date(d) for d in days if d is not None)
    parts = [f"{DAY} IN ({known})"] if known else []
    return " OR ".join([*parts, *([f"{DAY} IS NULL"] if None in days else [])]) or "false"


def _prepare(
    target: DataFrame, new: DataFrame, root: str, name: str, days_fixed: bool
) -> set[dt.date | None]:
    """Write the touched days in full to the pending folder and return them.

    Only day lists reach the driver; their length is bounded by the calendar.
    """
    spark = target.sparkSession
    ensure_checkpoint_dir(spark)
    new = new.checkpoint()
    per_day = {r[DAY]: r["count"] for r in new.groupBy(DAY).count().collect()}
    days = set(per_day)
    if not days:
        return days
    if not days_fixed:
        older = target.select(KEY, DAY).join(new.select(KEY).distinct(), KEY, "left_semi")
        days |= {r[DAY] for r in older.select(DAY).distinct().collect()}
    merged = upsert(target.filter(_in_days(days)), new, KEY)
    pending = _pending(root, name)
    tables.delete(spark, pending)
    merged.hint("rebalance", DAY).write.partitionBy(DAY).parquet(f"{pending}/rows")
    kept = spark.read.schema(target.schema).parquet(f"{pending}/rows").select(DAY).distinct()
    emptied = sorted(str(d) for d in days - {r[DAY] for r in kept.collect()} if d is not None)
    spark.createDataFrame([(d,) for d in emptied], "day string").write.parquet(f"{pending}/emptied")
    return days


def _apply_pending(spark: SparkSession, root: str, name: str) -> None:
    """Replace the touched days in the stored table; safe to repeat.

    A pending folder of other columns or types was prepared for a table that is no more. It is
    dropped: its rows are still past the stored table's mark and come again.
    """
    pending = _pending(root, name)
    if not tables.finished(spark, f"{pending}/emptied"):
        return
    path = tables.current_path(spark, root, name)
    stored = tables.read_version(spark, path)
    rows = spark.read.schema(stored.schema).parquet(f"{pending}/rows")
    # The day's own type is a guess from folder names, and no date where only its NULL folder is.
    if not rows.isEmpty() and _fields(spark.read.parquet(f"{pending}/rows").drop(DAY)) != _fields(
        stored.drop(DAY)
    ):
        tables.delete(spark, pending)
        return
    # Pending files hold one day each already, so they are copied without a shuffle.
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
    for row in spark.read.schema("day string").parquet(f"{pending}/emptied").collect():
        tables.delete(spark, f"{path}/{DAY}={row.day}")
    tables.delete(spark, pending)
