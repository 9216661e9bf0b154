"""The chain of commits that says which files a store of tables consists of.

A commit is one small file, ``_commits/<n>``, that names every live folder. It is written aside and
renamed to a name that must not exist, so of two writers that saw the same last commit one fails
and looks again. All tables of a batch become visible with that rename, or none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Commits before the newest that stay, for readers that have just listed them.
KEPT_COMMITS = 20


class Conflict(RuntimeError):
    """Another writer holds the store, or was faster."""


@dataclass(frozen=True)
class Commit:
    """What the store holds after one commit.

    ``batch`` is the last ingest batch and ``writer`` the stream that may add the next. ``streams``
    has, for each stream, its last batch there and here, and the last batch here that its own state
    of seen ids covers. ``live`` lists (batch, folder) of the batches of each table that are not
    compacted, ``days`` names the manifest of the compacted ones, ``stock`` lists (level, folder)
    of the changes of stock. ``retired`` folders are of no use to new readers.
    """

    number: int = -1
    batch: int = -1
    at: str | None = None
    writer: str | None = None
    streams: dict[str, dict[str, int]] = field(default_factory=dict)
    live: dict[str, list[tuple[int, str]]] = field(default_factory=dict)
    days: dict[str, str] = field(default_factory=dict)
    stock: list[tuple[int, str]] = field(default_factory=list)
    retired: list[str] = field(default_factory=list)


def _folder(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _folder(spark, path)
    return fs.exists(folder)


def delete(spark: SparkSession, path: str) -> None:
    fs, folder = _folder(spark, path)
    fs.delete(folder, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is missing."""
    fs, folder = _folder(spark, path)
    if not fs.exists(folder):
        return []
    return [status.getPath().getName() for status in fs.listStatus(folder)]


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _folder(spark, path)
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, replaced if it is there."""
    fs, file = _folder(spark, path)
    out = fs.create(file, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that appears whole, or not at all where there is one of the name already."""
    fs, file = _folder(spark, path)
    aside = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    write_text(spark, aside, text)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    options = spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_folder(spark, aside)[1], file, options)
    except Py4JJavaError:
        delete(spark, aside)
        if fs.exists(file):
            return False
        raise
    return True


def newest(spark: SparkSession, root: str) -> Commit:
    """The last commit; an empty one before the first."""
    numbers = [int(n) for n in names(spark, f"{root}/_commits") if n.isdigit()]
    if not numbers:
        return Commit()
    known = Commit(**json.loads(read_text(spark, f"{root}/_commits/{max(numbers)}")))
    live = {table: [tuple(entry) for entry in entries] for table, entries in known.live.items()}
    return replace(known, live=live, stock=[tuple(entry) for entry in known.stock])


def commit(spark: SparkSession, root: str, change: Callable[[Commit], Commit | None]) -> Commit:
    """Add the commit that ``change`` makes of the last one, looking again if another came first.

    ``change`` raises ``Conflict`` where it no longer applies, and gives None where there is
    nothing to do.
    """
    while True:
        last = newest(spark, root)
        after = change(last)
        if after is None:
            return last
        after = replace(after, number=last.number + 1)
        if create(spark, f"{root}/_commits/{after.number}", json.dumps(asdict(after))):
            delete(spark, f"{root}/_commits/{after.number - KEPT_COMMITS}")
            return after
