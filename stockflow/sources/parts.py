"""Tables in parts: versions that share the files of the parts that did not change.

A version is one small file that names the folders of every part (a day, a week) and the columns
they have. It is created under a number that must be free, so of two runs one fails; readers of an
older version keep its files until two newer ones exist.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stockflow.sources import commits
from stockflow.sources.commits import Conflict

KEPT_VERSIONS = 2


class Version(NamedTuple):
    """Folders by part, the schema as JSON, and what the writer noted."""

    number: int
    parts: dict[str, list[str]]
    schema: str
    facts: dict


class Staged(NamedTuple):
    """Rows that are written and not yet part of a version."""

    folder: str
    parts: list[str]
    schema: str


def _version(spark: SparkSession, root: str, name: str, number: int) -> Version:
    text = commits.read_text(spark, f"{root}/{name}/_versions/{number}")
    return Version(number, **json.loads(text))


def _numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    return sorted(int(n) for n in commits.names(spark, f"{root}/{name}/_versions") if n.isdigit())


def newest(spark: SparkSession, root: str, name: str) -> Version | None:
    numbers = _numbers(spark, root, name)
    return _version(spark, root, name, numbers[-1]) if numbers else None


def _read(spark: SparkSession, root: str, schema: str, folders: list[str]) -> DataFrame:
    kind = T.StructType.fromJson(json.loads(schema))
    if not folders:
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(*[f"{root}/{f}" for f in folders])


def read(
    spark: SparkSession,
    root: str,
    name: str,
    version: Version | None = None,
    keep: Callable[[str], bool] = lambda part: True,
) -> DataFrame:
    """The rows of the parts that ``keep`` wants; folders of others are not listed."""
    version = newest(spark, root, name) if version is None else version
    if version is None:
        raise FileNotFoundError(f"table {name} has no version under {root}")
    folders = [f for part, found in version.parts.items() if keep(part) for f in found]
    return _read(spark, root, version.schema, folders)


def stage(df: DataFrame, root: str, name: str, part: str) -> Staged:
    """Write rows by part, the text of expression ``part``, to a folder that no version has yet."""
    folder = f"{name}/{uuid.uuid4().hex}"
    rows = df.selectExpr("*", f"coalesce(string({part}), 'none') AS _part").hint("rebalance", "_part")
    rows.write.partitionBy("_part").parquet(f"{root}/{folder}")
    found = commits.names(df.sparkSession, f"{root}/{folder}")
    return Staged(folder, [n.removeprefix("_part=") for n in found if n.startswith("_part=")], df.schema.json())


def staged_rows(spark: SparkSession, root: str, staged: Staged) -> DataFrame:
    return _read(spark, root, staged.schema, [f"{staged.folder}/_part={p}" for p in staged.parts])


def publish(
    spark: SparkSession,
    root: str,
    name: str,
    staged: Staged,
    before: Version | None = None,
    replaced: Callable[[str], bool] = lambda part: True,
    facts: dict | None = None,
) -> Version:
    """A version of the parts of ``before`` that are not ``replaced``, and of the staged rows."""
    parts = {p: f for p, f in before.parts.items() if not replaced(p)} if before else {}
    for p in staged.parts:
        parts[p] = [*parts.get(p, []), f"{staged.folder}/_part={p}"]
    numbers = _numbers(spark, root, name)
    seen = before.number if before else (numbers[-1] if numbers else -1)
    version = Version(seen + 1, parts, staged.schema, facts or {})
    text = json.dumps({"parts": version.parts, "schema": version.schema, "facts": version.facts})
    if not commits.create(spark, f"{root}/{name}/_versions/{version.number}", text):
        raise Conflict(f"another run wrote {name}")
    _forget(spark, root, name)
    return version


def _forget(spark: SparkSession, root: str, name: str) -> None:
    """Delete versions beyond the last ones, and the folders that only they name."""
    numbers = _numbers(spark, root, name)
    old = [_version(spark, root, name, n) for n in numbers[:-KEPT_VERSIONS]]
    kept = [_version(spark, root, name, n) for n in numbers[-KEPT_VERSIONS:]]
    used = {f for v in kept for found in v.parts.values() for f in found}
    for version in old:
        for folder in {f for found in version.parts.values() for f in found} - used:
            commits.delete(spark, f"{root}/{folder}")
        commits.delete(spark, f"{root}/{name}/_versions/{version.number}")
