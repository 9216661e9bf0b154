"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.session import ensure_checkpoint_dir


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="stockflow-")) / "stockflow-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in package.rglob("*.py"):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


#: What modules keep in a worker between partitions, and how to forget it.
_KEPT: dict[str, Callable[[], None]] = {}


def kept_in_workers(module: str, forget: Callable[[], None]) -> None:
    """Name what ``module`` keeps between its partitions; a partition of another one forgets it."""
    _KEPT[module] = forget


def _make_room(module: str) -> None:
    for other, forget in _KEPT.items():
        if other != module:
            forget()


def _give_back() -> None:
    """Return freed memory to the system: workers are used again and would keep the most they had."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        return


def map_arrow(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers, which keep little after a partition."""

    def once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _make_room(run.__module__)
        _give_back()
        yield from run(batches)
        _give_back()

    ship_package(df.sparkSession)
    return df.mapInArrow(once, schema)


def hash_share(df: DataFrame, limit: int, *columns: str) -> DataFrame:
    """About ``limit`` rows of ``df``, all if it has no more: those of the least hash of ``columns``.

    The hash at which to cut comes from the number of rows, so no rows are sorted or gathered.
    """
    n = df.count()
    if n <= limit:
        return df
    most = (1 << 63) - 1
    hashed = F.xxhash64(*[F.col(c) for c in columns]).bitwiseAND(F.lit(most))
    return df.filter(hashed < F.lit(int(most * (limit / n))))


def scratch_folder(spark: SparkSession) -> str:
    """The session's folder under ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage: a lost executor costs the reader nothing that was computed before. The
    files stay until ``clear_scratch`` or until the shared folder is emptied.
    """
    path = f"{scratch_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    # The shuffle files of this job are deleted once the driver's JVM has collected the plan that
    # refers to them; nothing refers to it now, but a collection may be long in coming.
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Delete every stored intermediate of this session; call it when results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def annotate(
    docs: DataFrame, keep: list[str], fields: str, compute: Callable[[pa.Array], dict[str, object]]
) -> DataFrame:
    """The columns ``keep`` as a struct ``row``, and ``fields`` computed from each batch of texts.

    ``compute`` gets the column ``text`` as an Arrow array and returns a sequence per field. The
    struct keeps columns of any name apart from the computed ones.
    """
    added = T.StructType.fromDDL(fields)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col("text").alias("text"))
    row = packed.schema["row"]
    arrow = T.StructType([*added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(arrow)
        for batch in batches:
            got = compute(batch["text"])
            columns = [c if isinstance(c := got[k.name], pa.Array) else pa.array(c, k.type) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch["row"], *columns], ["row", *kinds.names])

    run.__module__ = compute.__module__
    return map_arrow(packed, run, T.StructType([row, *added.fields]))
