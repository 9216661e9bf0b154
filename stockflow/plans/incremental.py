"""Marts and reports brought up to date from the days that changed.

A stored snapshot carries every SKU's running stock and daily sales, so a run reads the 29 days
before the first changed one, the staging days from there on, and nothing older. Weeks and reports
follow the same way. Each result equals a full rebuild.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions import scalars as S
from stockflow.operators import daily
from stockflow.plans import marts, reports
from stockflow.sources import parts
from stockflow.sources.parts import Staged, Version

SNAPSHOT, VELOCITY, LAST_WEEKS = "fct_inventory_snapshot", "fct_sales_velocity", "_last_weeks"
#: The longest rolling frame, in rows, less the row itself.
BACK = 29
#: Folders of one day before the snapshot is written anew; each SKU that is new adds one.
FOLDERS_OF_A_DAY = 8

Check = Callable[[dict[str, DataFrame]], None]


class Change(NamedTuple):
    """What a run changed: days from ``first`` on (None: no day), and all of them for new SKUs.

    ``whole`` is a rebuild. ``sale_days`` are the days of the new sales.
    """

    whole: bool
    first: dt.date | None
    new_skus: bool
    sale_days: set[dt.date]

    @property
    def nothing(self) -> bool:
        return not (self.whole or self.first or self.new_skus or self.sale_days)


def _days(rows: DataFrame, start: dt.date, as_of: dt.date) -> set[dt.date]:
    """Days of the rows inside the calendar, which bounds their number."""
    inside = rows.filter(f"event_date BETWEEN {S.date(start)} AND {S.date(as_of)}")
    return {r["event_date"] for r in inside.select("event_date").distinct().collect()}


def refresh_snapshot(
    spark: SparkSession,
    root: str,
    sales: DataFrame,
    moves: DataFrame,
    fresh: Callable[[int], tuple[DataFrame, DataFrame]],
    last: int,
    start: dt.date,
    as_of: dt.date,
    check: Check,
    full: bool = False,
) -> tuple[DataFrame, Change]:
    """Bring the stored snapshot up to ingest batch ``last`` and day ``as_of``; test what is written.

    ``fresh`` gives the staging rows of the ingest batches past one. Days from the first that they
    touch, or that the calendar adds, are replaced. A SKU that is new gets its rows on every earlier
    day too, in files beside those that are there. A SKU under a further category changes its whole
    history, and so does an earlier ``as_of`` or another ``start``: then all is built anew.
    """
    before = parts.newest(spark, root, SNAPSHOT)
    facts = {"start": start.isoformat(), "as_of": as_of.isoformat(), "batch": last}

    def written(staged: Staged, replaced: Callable[[str], bool], old: Version | None) -> DataFrame:
        check({SNAPSHOT: parts.staged_rows(spark, root, staged)})
        version = parts.publish(spark, root, SNAPSHOT, staged, old, replaced, facts)
        return _shown(parts.read(spark, root, SNAPSHOT, version))

    def anew() -> tuple[DataFrame, Change]:
        rows = marts.snapshot_columns(daily.dense_activity(sales, moves, start, as_of), keep=["running_stock"])
        return written(parts.stage(rows, root, SNAPSHOT, "snapshot_date"), lambda part: True, before), Change(
            True, start, True, set()
        )

    known_facts = before.facts if before else {}
    if full or not before or known_facts["start"] != facts["start"] or known_facts["as_of"] > facts["as_of"]:
        return anew()
    new_sales, new_moves = fresh(known_facts["batch"])
    was = dt.date.fromisoformat(known_facts["as_of"])
    known = parts.read(spark, root, SNAPSHOT, before, lambda part: part == was.isoformat()).select("sku", "category")
    pairs = daily.sku_dimension(new_sales, new_moves).filter("sku IS NOT NULL")
    same = (F.col("p.sku") == F.col("k.sku")) & F.col("p.category").eqNullSafe(F.col("k.category"))
    added = pairs.alias("p").join(known.alias("k"), same, "left_anti").persist()
    try:
        skus = added.select("sku").distinct()
        if not added.join(known, "sku", "left_semi").isEmpty() or added.count() > skus.count():
            return anew()
        any_new = not skus.isEmpty()
        if any_new and max(map(len, before.parts.values()), default=0) >= FOLDERS_OF_A_DAY:
            return anew()
        sale_days = _days(new_sales, start, as_of)
        touched = sale_days | _days(new_moves, start, as_of)
        touched |= {was + dt.timedelta(days=1)} if was < as_of else set()
        first = min(touched, default=None)
        change = Change(False, first, any_new, sale_days)
        if change.nothing:
            return _shown(parts.read(spark, root, SNAPSHOT, before)), change
        rows = []
        if first is not None:
            rows.append(_extended(spark, root, before, sales, moves, known, first, as_of))
        if any_new:
            mine = [df.join(skus, "sku", "left_semi") for df in (new_sales, new_moves)]
            activity = daily.dense_activity(*mine, start, as_of, added)
            rows.append(marts.snapshot_columns(activity, keep=["running_stock"]))
        both = rows[0] if len(rows) == 1 else rows[0].unionByName(rows[1])
        staged = parts.stage(both, root, SNAPSHOT, "snapshot_date")
        cut = "9" if first is None else first.isoformat()
        return written(staged, lambda part: part >= cut, before), change
    finally:
        added.unpersist()


def _shown(snapshot: DataFrame) -> DataFrame:
    return snapshot.drop("running_stock")


def _extended(
    spark: SparkSession,
    root: str,
    before: Version,
    sales: DataFrame,
    moves: DataFrame,
    known: DataFrame,
    first: dt.date,
    as_of: dt.date,
) -> DataFrame:
    """Rows of the known SKUs from day ``first`` on, from the stored days before it.

    Stored rows enter with the change of stock that leads to their running stock, the first with
    all of it, so one series of windows serves both.
    """
    since = first - dt.timedelta(days=BACK)
    wanted = lambda part: since.isoformat() <= part < first.isoformat()
    history = parts.read(spark, root, SNAPSHOT, before, wanted)
    series = "OVER (PARTITION BY sku ORDER BY snapshot_date)"
    carried = history.selectExpr(
        "snapshot_date",
        "sku",
        "category",
        f"running_stock - coalesce(lag(running_stock) {series}, 0L) + units_sold AS stock_received",
        "units_sold",
        "gross_revenue",
        "net_revenue",
    )
    late = f"event_date >= {S.date(first)}"
    activity = daily.dense_activity(sales.filter(late), moves.filter(late), first, as_of, known)
    rows = marts.snapshot_columns(carried.unionByName(activity), keep=["running_stock"])
    return rows.filter(f"snapshot_date >= {S.date(first)}")


def _monday(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def refresh_velocity(
    spark: SparkSession, root: str, sales: DataFrame, change: Change, check: Check
) -> DataFrame:
    """Bring weekly velocity up to date: weeks from the first changed day's on are replaced.

    The change against the week before needs each SKU and channel's latest earlier row; those
    before the newest stored week are kept beside the table, so older weeks are read only when one
    of them changes.
    """
    before = parts.newest(spark, root, VELOCITY)
    since = min([d for d in (change.first, *change.sale_days) if d], default=None)
    whole = change.whole or change.new_skus or before is None
    if before is not None and change.nothing:
        return parts.read(spark, root, VELOCITY, before)
    if whole:
        rows = marts.sales_velocity(sales, _shown(parts.read(spark, root, SNAPSHOT)))
        prior, cut = None, ""
    else:
        week = _monday(since)
        cut = week.isoformat()
        prior = _last_rows(spark, root, before, cut)
        recent = _shown(parts.read(spark, root, SNAPSHOT, None, lambda part: part >= cut))
        rows = marts.sales_velocity(sales.filter(f"event_date >= {S.date(week)}"), recent, prior)
        rows = rows.filter(f"week_start >= {S.date(week)}")
    staged = parts.stage(rows, root, VELOCITY, "week_start")
    written = parts.staged_rows(spark, root, staged)
    check({VELOCITY: written})
    weeks = sorted(p for p in staged.parts if p != "none")
    newest = weeks[-1] if weeks else (before.facts["newest"] if before else "")
    state = written.filter(f"string(week_start) < '{newest}'").select(*_LAST)
    if prior is not None:
        state = state.unionByName(prior.select(*_LAST))
    kept = parts.stage(_latest(state), root, LAST_WEEKS, "'all'")
    version = parts.publish(spark, root, VELOCITY, staged, before, lambda p: p >= cut, {"newest": newest})
    parts.publish(spark, root, LAST_WEEKS, kept, parts.newest(spark, root, LAST_WEEKS), facts={"of": version.number})
    return parts.read(spark, root, VELOCITY, version)


_LAST = ["week_start", "category", "channel", "sku", "units_sold", "net_revenue"]


def _latest(rows: DataFrame) -> DataFrame:
    """The row of each SKU and channel that a later week is compared with."""
    order = "struct(week_start, category, units_sold, net_revenue)"
    best = rows.groupBy("sku", "channel").agg(F.expr(f"max({order}) AS best"))
    return best.select("sku", "channel", "best.*").select(*_LAST)


def _last_rows(spark: SparkSession, root: str, before: Version, cut: str) -> DataFrame:
    """Of each SKU and channel the latest stored row of a week before ``cut``."""
    state = parts.newest(spark, root, LAST_WEEKS)
    newest = before.facts["newest"]
    if state is not None and state.facts["of"] == before.number and cut >= newest:
        recent = parts.read(spark, root, VELOCITY, before, lambda p: newest <= p < cut).select(*_LAST)
        return _latest(parts.read(spark, root, LAST_WEEKS, state).unionByName(recent))
    return _latest(parts.read(spark, root, VELOCITY, before, lambda p: p < cut).select(*_LAST))


def refresh_category_summary(spark: SparkSession, root: str, change: Change) -> DataFrame:
    """Bring the category report up to date: days of replaced snapshot rows are computed again."""
    name = "mv_category_daily_summary"
    before = parts.newest(spark, root, name)
    if before is not None and not (change.whole or change.new_skus or change.first):
        return parts.read(spark, root, name, before)
    whole = change.whole or change.new_skus or before is None
    cut = "" if whole else change.first.isoformat()
    snapshot = _shown(parts.read(spark, root, SNAPSHOT, None, lambda p: p >= cut))
    staged = parts.stage(reports.category_daily_summary(snapshot), root, name, "snapshot_date")
    return parts.read(spark, root, name, parts.publish(spark, root, name, staged, before, lambda p: p >= cut))


def refresh_channel_revenue(spark: SparkSession, root: str, sales: DataFrame, change: Change) -> DataFrame:
    """Bring the channel report up to date: the weeks that new sales fall into are computed again."""
    name = "mv_channel_revenue_weekly"
    before = parts.newest(spark, root, name)
    whole = change.whole or before is None
    weeks = {_monday(d) for d in change.sale_days}
    if not whole and not weeks:
        return parts.read(spark, root, name, before)
    if not whole:
        spans = [f"event_date BETWEEN {S.date(w)} AND {S.date(w + dt.timedelta(days=6))}" for w in sorted(weeks)]
        sales = sales.filter(" OR ".join(spans))
    staged = parts.stage(reports.channel_revenue_weekly(sales), root, name, "week_start")
    gone = {w.isoformat() for w in weeks}
    return parts.read(spark, root, name, parts.publish(spark, root, name, staged, before, lambda p: whole or p in gone))
