"""Near-duplicates by SimHash and covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.components import components
from stockflow.llm.store import map_arrow, stored

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Buckets of more distinct fingerprints than this are hashed again instead of compared.
BUCKET = 512
_BITS = 64
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is set if more than half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    n = max(1, len(words) - shingle + 1)
    first, last = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(_BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for i in range(0, n, _CHUNK):
        hashes = [digest(joined[s:e], SEED) for s, e in zip(first[i : i + _CHUNK], last[i : i + _CHUNK])]
        octets = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, key: str = "doc_id") -> DataFrame:
    """``key`` and fingerprint (as a signed bigint ``fp``) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch[key], pa.array(prints.view(np.int64))], [key, "fp"])

    return map_arrow(docs.select(key, "text"), run, f"{key} {dict(docs.dtypes)[key]}, fp long")


def masks(radius: int, level: int = 0) -> list[int]:
    """Covering masks: 2^(radius+1) - 1 of them.

    Each bit position has a non-zero vector of radius + 1 bits; mask v keeps the positions whose
    vector has an odd product with v. At most ``radius`` vectors span less than the whole space,
    so some v is orthogonal to all of them: that mask hides every differing bit of a pair within
    the radius, and the pair shares its bucket. ``level`` deals the vectors anew.
    """
    count = 2 ** (radius + 1) - 1
    vectors = np.random.default_rng([radius, level]).permutation(_BITS) % count + 1
    out = []
    for v in range(1, count + 1):
        kept = sum(1 << i for i, m in enumerate(vectors.tolist()) if (m & v).bit_count() % 2)
        out.append(kept - (1 << _BITS) if kept >> (_BITS - 1) else kept)
    return out


def _keys(bucket: Column, radius: int, level: int) -> Column:
    return F.array(
        *[F.xxhash64(bucket, F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(masks(radius, level))]
    )


def spanning_links(prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that connect what pairs within the radius connect, fewer than there are prints."""
    rest = np.arange(len(prints))
    out = []
    while len(rest):
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = np.bitwise_count((prints[rest] ^ prints[at]).view(np.uint64)) <= radius
            out += [(at, to) for to in rest[near].tolist()]
            reached += rest[near].tolist()
            rest = rest[~near]
    return out


def _link_buckets(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for members in batch["members"].to_pylist():
                prints = np.array(sorted(members), dtype=np.int64)
                for a, b in spanning_links(prints, radius):
                    left.append(int(prints[a]))
                    right.append(int(prints[b]))
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["u", "v"])

    return run


def links(prints: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (u, v) between distinct fingerprints ``fp`` that connect all within the radius.

    A bucket of at most ``bucket`` fingerprints is compared in one task and gives a spanning
    forest, never all pairs. A larger one is hashed again with masks dealt anew: its members
    already agree on about half of the bits, each further level fixes half of the rest, and the
    covering guarantee holds at each, so no link is lost and no bucket stays large. (Distinct
    prints that agree on all but f bits number at most 2^f.)
    """
    pending = prints.select("fp", F.lit(0).cast("long").alias("bucket"))
    found = None
    for level in range(_BITS):
        keys = pending.select(F.explode(_keys(F.col("bucket"), radius, level)).alias("key"), "fp")
        sizes = stored(keys.groupBy("key").agg(F.count("*").alias("n")).filter("n >= 2"))
        shared = keys.join(sizes, "key")
        members = shared.filter(F.col("n") <= bucket).groupBy("key").agg(F.collect_list("fp").alias("members"))
        new = stored(map_arrow(members.select("members"), _link_buckets(radius), "u long, v long").distinct())
        found = new if found is None else found.unionByName(new)
        if sizes.filter(F.col("n") > bucket).isEmpty():
            break
        pending = stored(shared.filter(F.col("n") > bucket).select("fp", F.col("key").alias("bucket")))
    return found


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row.

    Texts without a word, null ones included, have the fingerprint zero and are linked like any
    other. component_id is the least non-null doc_id reachable over links, null if there is none.
    Repeated rows and ids are rows like others; an empty table gives no rows; other columns of
    ``docs`` are ignored. Copies meet in their fingerprint before any comparison.
    """
    prints = stored(fingerprints(docs, shingle))
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    parts = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    placed = distinct.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = placed.groupBy("component").agg(F.min("first").alias("component_id"))
    by_print = placed.join(least, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: each component keeps its least doc_id.

    All columns are returned unchanged. Rows that repeat a doc_id count as one document, of which
    the row with the least text stays. Documents without a doc_id are told apart by their text; a
    component of such documents alone keeps one of them.
    """
    by_id, by_text = F.col("doc_id").cast("string"), F.concat(F.lit("t"), F.xxhash64("text").cast("string"))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce(by_id, by_text).alias("id"), "text")
    prints = stored(fingerprints(rows, shingle, "id"))
    numbers = prints.select(F.expr("try_cast(id AS long)").alias("doc_id"), "fp", "id")
    distinct = stored(numbers.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "id")).alias("first")))
    parts = components(links(distinct, radius)).withColumnRenamed("node", "fp")
    placed = distinct.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    kept = placed.groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.id").alias("id"))
    found = rows.join(kept, "id", "left_semi")
    return found.selectExpr("*", "row_number() OVER (PARTITION BY id ORDER BY text) AS place").filter("place = 1").select("row.*")
