"""Centroid clustering: exact k-means over integers, nearest centroids by Walsh-Hadamard search."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.llm.store import map_arrow, stored

SIZE = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
#: Where a level of the search begins, in coefficients: few coarse ones first, then twice as many.
LEVELS = (0, 1, 2, 4, 8, 16, 32, 64)
#: Components up to this size leave every sum of the search below 2^63; beyond it Python's integers count.
NARROW = 1 << 20
#: Vectors that are compared at a time.
BLOCK = 4096


def _sequency(size: int) -> np.ndarray:
    """The rows of the Walsh-Hadamard matrix, fewest sign changes first."""
    rows = np.ones((1, 1), dtype=np.int64)
    while len(rows) < size:
        rows = np.block([[rows, rows], [rows, -rows]])
    return np.argsort((np.diff(rows, axis=1) != 0).sum(axis=1), kind="stable")


_ORDER = _sequency(SIZE)


def transform(vectors: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard coefficients of integer rows, coarse to fine, by sums and differences alone.

    The squared distance of two rows of coefficients is ``SIZE`` times that of the vectors.
    """
    out = vectors
    half = 1
    while half < SIZE:
        pairs = out.reshape(len(out), SIZE // (2 * half), 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        out = np.stack([a + b, a - b], axis=2).reshape(len(out), SIZE)
        half *= 2
    return out[:, _ORDER]


def _rests(coefficients: np.ndarray) -> np.ndarray:
    """For each level the energy of the coefficients that are not yet summed after it."""
    squares = coefficients * coefficients
    tail = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    tail = np.concatenate([tail, np.zeros((len(tail), 1), dtype=tail.dtype)], axis=1)
    return tail[:, list(LEVELS[1:])]


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, the first among equals, and the squared distance.

    Pairs of vector and centroid gain their squared coefficient differences level by level. What a
    pair has is a lower bound; with twice the energy of both rests it is an upper one. A pair above
    the least upper bound of its vector is strictly worse than some centroid and is dropped; those
    that stay get all ``SIZE`` coefficients. All sums are whole numbers.
    """
    k = len(centroids)
    x, c = transform(vectors), transform(centroids)
    x_rest, c_rest = _rests(x), _rests(c)
    row = np.repeat(np.arange(len(x)), k)
    at = np.tile(np.arange(k), len(x))
    total = np.zeros(len(row), dtype=x.dtype)
    for level, (a, b) in enumerate(zip(LEVELS, LEVELS[1:])):
        gap = x[row, a:b] - c[at, a:b]
        total = total + (gap * gap).sum(axis=1)
        begins = np.flatnonzero(np.diff(row, prepend=-1))
        most = total + 2 * (x_rest[row, level] + c_rest[at, level])
        least = np.minimum.reduceat(most, begins)
        kept = total <= np.repeat(least, np.diff(begins, append=len(row)))
        row, at, total = row[kept], at[kept], total[kept]
    begins = np.flatnonzero(np.diff(row, prepend=-1))
    return at[begins], total[begins] // SIZE


def _whole(x: float) -> int:
    """floor(1024 x) without overflow."""
    return math.floor(x * SCALE) if abs(x) < 2.0**53 else int(x) * SCALE


def integers(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(places, integer rows) of a column of vectors: those of machine size, then the others."""
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(column), SIZE)
    narrow = (np.abs(flat) * SCALE <= NARROW).all(axis=1)
    out = [(np.flatnonzero(narrow), np.floor(flat[narrow] * SCALE).astype(np.int64))]
    if not narrow.all():
        wide = [[_whole(x) for x in row] for row in flat[~narrow].tolist()]
        out.append((np.flatnonzero(~narrow), np.array(wide, dtype=object).reshape(-1, SIZE)))
    return [(places, rows) for places, rows in out if len(places)]


def _assigned(column: pa.Array, centroids: list[list[int]]) -> Iterator[tuple[np.ndarray, ...]]:
    """(places, integer rows, cluster, distance) of blocks of a column of vectors."""
    narrow = all(abs(v) <= NARROW for c in centroids for v in c)
    centres = np.array(centroids, dtype=np.int64 if narrow else object).reshape(-1, SIZE)
    for places, rows in integers(column):
        for a in range(0, len(places), BLOCK):
            part = rows[a : a + BLOCK]
            same = part.dtype == centres.dtype
            found = nearest(part if same else part.astype(object), centres if same else centres.astype(object))
            yield places[a : a + BLOCK], part, *found


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number of any size as (n, part), the sum of part * 2^(40 n), each part below 2^62."""
    n = 0
    while not -(1 << 62) <= value < 1 << 62:
        yield n, value & (1 << 40) - 1
        value >>= 40
        n += 1
    yield n, value


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> dict[int, tuple[int, list[int]]]:
    """Per cluster the number of its vectors and their componentwise sums.

    A task sums its own vectors; the driver gets one row per cluster, component and limb.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = [0] * len(centroids)
        total = [[0] * SIZE for _ in centroids]
        for batch in batches:
            for _, rows, cluster, _ in _assigned(batch["embedding"], centroids):
                for c in np.unique(cluster).tolist():
                    chosen = rows[cluster == c]
                    count[c] += len(chosen)
                    total[c] = [a + int(b) for a, b in zip(total[c], chosen.sum(axis=0))]
        out = [
            (c, count[c], d, n, part)
            for c in range(len(centroids))
            if count[c]
            for d in range(SIZE)
            for n, part in _limbs(total[c][d])
        ]
        columns = [pa.array([r[i] for r in out], pa.int64()) for i in range(5)]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "count", "component", "limb", "part"])

    parts = map_arrow(vectors.select("embedding"), run, "cluster long, count long, component long, limb long, part long")
    rows = (
        parts.groupBy("cluster", "component", "limb")
        .agg(F.sum(F.expr("IF(limb = 0, count, 0)")).alias("count"), F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
        .collect()
    )
    sums: dict[int, tuple[int, list[int]]] = {}
    for r in rows:
        count, total = sums.get(r["cluster"], (0, [0] * SIZE))
        total[r["component"]] += int(r["part"]) << 40 * r["limb"]
        sums[r["cluster"]] = (max(count, r["count"]), total)
    return sums


def _usable(table: DataFrame) -> DataFrame:
    finite = "forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    return table.select("vec_id", "embedding").filter(f"size(embedding) = {SIZE} AND {finite}")


def _first_centroids(vectors: DataFrame, clusters: int, seed: int) -> list[list[int]]:
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(name.asc_nulls_last(), "embedding").limit(clusters).collect()
    return [[_whole(float(x)) for x in r["embedding"]] for r in rows]


def fit(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3) -> list[list[int]]:
    """The centroids after ``rounds`` rounds; fewer than ``clusters`` if there are fewer vectors.

    Each round is one pass that leaves one sum per cluster and component.
    """
    centroids = _first_centroids(vectors, clusters, seed)
    for _ in range(rounds if centroids else 0):
        before = centroids
        sums = _sums(vectors, centroids)
        centroids = [[t // sums[c][0] for t in sums[c][1]] if c in sums else old for c, old in enumerate(before)]
        if centroids == before:
            break
    return centroids


def _fitting(value: int | None) -> int | None:
    return value if value is not None and -(1 << 63) <= value < 1 << 63 else None


def cluster(
    table: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = 3
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of each usable vector.

    Usable are vectors of exactly ``SIZE`` components, none null or non-finite; the others have no
    row. Repeated ids are vectors like others, and between equal hashes of ids the lesser vector is
    the earlier centroid; a null id is a centroid only if others are too few. An empty table gives
    no rows; other columns are ignored. Components of any finite size are counted exactly; a
    distance or inertia beyond 63 bits is null.

    Once the centroids repeat, further rounds would change nothing and are not run.
    """
    spark: SparkSession = table.sparkSession
    vectors = stored(_usable(table))
    centroids = fit(vectors, clusters, rounds, seed)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    wide = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, _, found, distance in _assigned(batch["embedding"], centroids):
                exact = [int(d) if d < 10**38 else None for d in distance]
                columns = [batch["vec_id"].take(pa.array(places)), pa.array(found, pa.int32()), pa.array(exact, wide)]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    kind = dict(table.dtypes)["vec_id"]
    placed = stored(map_arrow(vectors, run, f"vec_id {kind}, cluster int, distance decimal(38,0)"))
    sums = placed.groupBy("cluster").agg(
        F.expr("IF(count(distance) = count(*), sum(distance), NULL)").alias("sum")
    ).collect()
    inertia = {r["cluster"]: None if r["sum"] is None else int(r["sum"]) for r in sums}
    total = None if None in inertia.values() else sum(inertia.values())
    rows = [(c, _fitting(s), _fitting(total), digests[c]) for c, s in inertia.items()]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(known), "cluster").select(
        "vec_id",
        "cluster",
        F.expr("try_cast(distance AS long)").alias("distance"),
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    )
