"""Parquet tables in a shared folder.

Append tables hold a folder per micro-batch until ``compact`` merges them into days; the newest
commit names the folders that count. Rebuilt tables hold one ``version=`` folder per rebuild;
readers take the newest finished one, so a rebuild never overwrites what it reads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.sources import commits
from stockflow.sources.commits import Commit, Conflict, delete, exists
from stockflow.sources.schemas import DAY_OF, INGEST_TABLES

KEPT_VERSIONS = 2
#: Runs of a compacted day that stay apart before they become one.
RUNS_OF_A_DAY = 4
#: Batches of a table that the hourly run leaves uncompacted.
LOOSE_BATCHES = 16


def finished(spark: SparkSession, path: str) -> bool:
    """True when the last write to ``path`` was committed."""
    return exists(spark, f"{path}/_SUCCESS")


def _numbers(spark: SparkSession, path: str, prefix: str) -> list[int]:
    found = commits.names(spark, path)
    return sorted(int(name.split("=")[1]) for name in found if name.startswith(f"{prefix}="))


def numbered(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The n of every finished ``<prefix>=n`` folder, ascending."""
    return [n for n in _numbers(spark, path, prefix) if finished(spark, f"{path}/{prefix}={n}")]


def newest(spark: SparkSession, path: str, prefix: str) -> int | None:
    """The largest n of a finished folder, looking at as few folders as possible."""
    downward = reversed(_numbers(spark, path, prefix))
    return next((n for n in downward if finished(spark, f"{path}/{prefix}={n}")), None)


# --- append tables -------------------------------------------------------------------


def ensure_tables(spark: SparkSession, root: str) -> None:
    """Begin the store: a first commit without rows, and a folder for each table."""
    for name in INGEST_TABLES:
        fs, folder = commits._folder(spark, f"{root}/{name}")
        fs.mkdirs(folder)
    commits.commit(spark, root, lambda last: Commit() if last.number < 0 else None)


def write_batch(df: DataFrame, root: str, name: str, batch_id: int) -> str:
    """Write a batch's rows to a folder of their own; they count once a commit names it."""
    folder = f"{name}/batch_id={batch_id}/part={uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    return folder


def _schema(name: str) -> T.StructType:
    return T.StructType([*INGEST_TABLES[name].fields, T.StructField("batch_id", T.LongType())])


def _loose(
    spark: SparkSession, root: str, name: str, folders: Sequence[str]
) -> DataFrame:
    """Rows of batch folders, with the number in their path."""
    paths = [f"{root}/{f}" for f in folders]
    rows = spark.read.schema(_schema(name)).option("basePath", f"{root}/{name}").parquet(*paths)
    return rows.select(*_schema(name).names)


def _manifest(spark: SparkSession, root: str, state: Commit, name: str) -> dict:
    """Last compacted batch and the folders of each day."""
    file = state.days.get(name)
    return json.loads(commits.read_text(spark, f"{root}/{file}")) if file else {"upto": -1, "days": {}}


def _compacted(spark: SparkSession, root: str, name: str, folders: Sequence[str]) -> DataFrame:
    paths = [f"{root}/{f}" for f in folders]
    return spark.read.schema(_schema(name)).parquet(*paths)


def read_batches(
    spark: SparkSession,
    root: str,
    name: str,
    after: int = -1,
    upto: int | None = None,
    state: Commit | None = None,
) -> DataFrame:
    """Committed rows of batches past ``after`` and up to ``upto``, with ``batch_id``.

    Folders of other batches are not opened, nor compacted days unless they have batches past
    ``after``; there the number is a column that row groups are skipped by.
    """
    state = commits.newest(spark, root) if state is None else state
    upto = state.batch if upto is None else upto
    parts = []
    loose = [folder for number, folder in state.live.get(name, []) if after < number <= upto]
    if loose:
        parts.append(_loose(spark, root, name, loose))
    manifest = _manifest(spark, root, state, name)
    if manifest["upto"] > after:
        folders = [f for runs in manifest["days"].values() for f in runs]
        rows = _compacted(spark, root, name, folders)
        bounds = [F.col("batch_id") > after] if after >= 0 else []
        bounds += [F.col("batch_id") <= upto] if manifest["upto"] > upto else []
        for bound in bounds:
            rows = rows.filter(bound)
        parts.append(rows)
    if not parts:
        return spark.createDataFrame([], _schema(name))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def last_committed(spark: SparkSession, root: str) -> int:
    """Number of the last batch whose ingest has finished in all tables, -1 without one."""
    return commits.newest(spark, root).batch


def committed(
    spark: SparkSession, root: str, name: str, after: int | None = None, upto: int | None = None
) -> DataFrame:
    """Rows of the committed batches, or of those past ``after`` and up to ``upto``."""
    return read_batches(spark, root, name, -1 if after is None else after, upto).drop("batch_id")


def compact(spark: SparkSession, root: str, name: str, least: int = 2) -> bool:
    """Merge the batch folders of a table into days, if there are ``least`` or more.

    Rows go to one run of files for each day they belong to; a day that has ``RUNS_OF_A_DAY`` runs
    is merged into one with the new rows. A read then lists a few folders a day, whatever the
    number of batches. Readers and writers go on meanwhile: the commit only takes the merged
    folders off the list, and the files stay until the next compaction. Done again, it finds
    nothing to merge.
    """
    state = commits.newest(spark, root)
    merged = [(number, folder) for number, folder in state.live.get(name, [])]
    if len(merged) < max(1, least):
        return False
    manifest = _manifest(spark, root, state, name)
    day = F.expr(f"coalesce(string({DAY_OF[name]}), 'none')")
    rows = _loose(spark, root, name, [folder for _, folder in merged]).withColumn("day", day)
    full = {d: runs for d, runs in manifest["days"].items() if len(runs) >= RUNS_OF_A_DAY}
    if full:
        # Only days that get rows are merged; which they are is a list bound by the calendar.
        full = {r["day"]: full[r["day"]] for r in rows.select("day").distinct().collect() if r["day"] in full}
    if full:
        folded = _compacted(spark, root, name, [f for runs in full.values() for f in runs])
        rows = rows.unionByName(folded.withColumn("day", day))
    run = f"{name}/runs/{uuid.uuid4().hex}"
    rows.hint("rebalance", "day").write.partitionBy("day").parquet(f"{root}/{run}")
    days = dict(manifest["days"])
    for found in commits.names(spark, f"{root}/{run}"):
        if found.startswith("day="):
            key = found.removeprefix("day=")
            days[key] = [*([] if key in full else days.get(key, [])), f"{run}/{found}"]
    file = f"_manifests/{name}-{uuid.uuid4().hex}.json"
    upto = max(number for number, _ in merged)
    commits.write_text(spark, f"{root}/{file}", json.dumps({"upto": upto, "days": days}))
    gone = [folder.rsplit("/", 1)[0] for _, folder in merged] + [f for runs in full.values() for f in runs]
    before = state.days.get(name)

    def change(last: Commit) -> Commit:
        if last.days.get(name) != before:
            raise Conflict(f"{name} was compacted meanwhile")
        done = {folder for _, folder in merged}
        left = [(number, folder) for number, folder in last.live.get(name, []) if folder not in done]
        mine = [f for f in last.retired if f.startswith((f"{name}/", f"_manifests/{name}-"))]
        retired = [f for f in last.retired if f not in mine] + gone + ([before] if before else [])
        return replace(last, live={**last.live, name: left}, days={**last.days, name: file}, retired=retired)

    after = commits.commit(spark, root, change)
    for folder in state.retired:
        if folder not in after.retired:
            delete(spark, f"{root}/{folder}")
    return True


def staged_upto(spark: SparkSession, root: str, name: str) -> int | None:
    """Number of the last batch that is in staging table ``name`` and passed its tests."""
    return newest(spark, f"{root}/_staged/{name}", "batch_id")


def mark_staged(spark: SparkSession, root: str, name: str, batch_id: int) -> None:
    """Record ``staged_upto``; a lost record costs a repeated upsert and no rows."""
    folder = f"{root}/_staged/{name}"
    before = _numbers(spark, folder, "batch_id")
    commits.write_text(spark, f"{folder}/batch_id={batch_id}/_SUCCESS", "")
    for old in before:
        if old != batch_id:
            delete(spark, f"{folder}/batch_id={old}")


# --- rebuilt tables ------------------------------------------------------------------


def current_path(spark: SparkSession, root: str, name: str) -> str | None:
    """Folder of the newest finished version, or None."""
    version = newest(spark, f"{root}/{name}", "version")
    return None if version is None else f"{root}/{name}/version={version}"


def read_current(spark: SparkSession, root: str, name: str) -> DataFrame:
    path = current_path(spark, root, name)
    if path is None:
        raise FileNotFoundError(f"table {name} has no finished version under {root}")
    return read_version(spark, path)


def logged_schema(spark: SparkSession, path: str) -> tuple[T.StructType | None, list[str]]:
    """The last schema noted for a version, None if its files have one, and the names it dropped."""
    log = sorted(int(n) for n in commits.names(spark, f"{path}/_schemas") if n.isdigit())
    if not log:
        return None, []
    noted = json.loads(commits.read_text(spark, f"{path}/_schemas/{log[-1]}"))
    return T.StructType.fromJson(noted["schema"]), noted["gone"]


def log_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """From now on the version at ``path`` is read in ``schema``; no file is written again.

    Files keep the columns and types they were written with: a reader casts the narrower ones,
    leaves out dropped columns and gives NULL for added ones.
    """
    before, gone = read_version(spark, path).columns, logged_schema(spark, path)[1]
    gone = sorted({*gone, *before} - {*schema.names})
    number = max([int(n) for n in commits.names(spark, f"{path}/_schemas") if n.isdigit()], default=-1) + 1
    if not commits.create(spark, f"{path}/_schemas/{number}", json.dumps({"schema": schema.jsonValue(), "gone": gone})):
        raise Conflict(f"another run changed the schema of {path}")


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a version in its last schema."""
    schema, _ = logged_schema(spark, path)
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(schema.names)


#: Whole numbers from narrow to wide.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _widens(old: T.DataType, new: T.DataType) -> bool:
    """True when a Parquet reader gives every value of ``old`` as ``new``, unchanged."""
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return old.scale == new.scale and old.precision <= new.precision
    a, b = old.simpleString(), new.simpleString()
    return a == b or (a in _WHOLE and b in _WHOLE and _WHOLE.index(a) < _WHOLE.index(b)) or (a, b) == ("float", "double")


def readable_as(spark: SparkSession, path: str, schema: T.StructType) -> bool:
    """True when ``log_schema`` can bring the version to ``schema``.

    Types may widen, columns may go and new ones come. A name that was dropped before cannot come
    back: older files still have its values.
    """
    old = {f.name: f.dataType for f in read_version(spark, path).schema}
    _, gone = logged_schema(spark, path)
    return all(_widens(old[f.name], f.dataType) if f.name in old else f.name not in gone for f in schema)


def rebuild(df: DataFrame, root: str, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a new version, drop all but the last two, and return the written rows.

    The rebalance hint gathers a partition value's rows into few files and lets AQE split
    the values that hold too many rows for one task.
    """
    spark = df.sparkSession
    versions = numbered(spark, f"{root}/{name}", "version")
    version = versions[-1] + 1 if versions else 0
    path = f"{root}/{name}/version={version}"
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    if partition_by and stored.isEmpty():
        # A partitioned write of no rows leaves no file to hold the schema.
        df.limit(0).write.mode("overwrite").parquet(path)
    for old in versions[: 1 - KEPT_VERSIONS]:
        delete(spark, f"{root}/{name}/version={old}")
    return stored.select(df.columns)
