"""Sharding by histogram sort: exact byte counts below probes, refined until splitters fit."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.store import stored

_WIDTH = 64
_STEP = 12
#: Bits of a key half that are open after each round of probes.
_OPEN = [*range(_WIDTH - _STEP, 0, -_STEP), 0]
#: Half of the key, bits open before (None: all of them) and after the round.
_ROUNDS = [(half, before, left) for half in ("hi", "lo") for before, left in zip([None, *_OPEN], _OPEN)]


@dataclass(frozen=True)
class Splitter:
    """The least key of a shard: ``hi``, and within that ``lo`` (None: all of it)."""

    hi: int
    lo: int | None = None

    def at_or_below(self) -> Column:
        hi = F.col("hi")
        if self.lo is None:
            return hi >= F.lit(self.hi)
        return (hi > F.lit(self.hi)) | ((hi == F.lit(self.hi)) & (F.col("lo") >= F.lit(self.lo)))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the two halves of the sort key; the text is read once here.

    ``hi`` hashes the text, so equal texts are neighbours; ``lo`` hashes the identity and orders
    copies among themselves.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.xxhash64(text).alias("hi"),
    ).withColumn("lo", F.xxhash64("doc_id", "hi"))


def splitters(keys: DataFrame, shards: int, tolerance: float = 0.001) -> list[Splitter]:
    """Keys that cut ``keys`` into byte ranges of equal size.

    Every round sums the exact bytes below 4,096 probes inside each interval that still holds an
    unmet target, so at most (shards - 1) * 4,096 sums reach the driver, whatever the input. A
    target is met when a probe lies within ``tolerance`` of a shard's size; otherwise the interval
    that straddles it is probed again, first along ``hi``, then along ``lo`` within one ``hi``
    (copies of one text heavier than the tolerance). Rows of equal keys cannot be cut: there the
    nearer side is taken.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    allowed = tolerance * total / shards
    targets = [total * k / shards for k in range(1, shards)]
    found: dict[int, Splitter] = {}
    # An interval is (hi value or None, prefix of the half in question or None for all of it);
    # each open target has the interval that straddles it and the bytes below that interval.
    open_targets = {k: ((None, None), 0) for k in range(len(targets))}
    for half, before, left in _ROUNDS:
        if half == "lo" and before is None:
            open_targets = {k: ((i[1], None), below) for k, (i, below) in open_targets.items()}
        if not open_targets:
            break
        cells = _histogram(keys, {i for i, _ in open_targets.values()}, half, before, left)
        still = {}
        for k, (interval, below) in open_targets.items():
            for probe, size in cells[interval]:
                if below + size >= targets[k]:
                    break
                below += size
            near, far = targets[k] - below, below + size - targets[k]
            finest = (half, left) == _ROUNDS[-1][::2]
            if near <= allowed or far <= allowed or finest:
                found[k] = _least(interval[0], probe + (far < near), left)
            else:
                still[k] = ((interval[0], probe), below)
        open_targets = still
    return [found[k] for k in sorted(found)]


def _histogram(
    keys: DataFrame, intervals: set[tuple], half: str, before: int | None, left: int
) -> dict[tuple, list[tuple[int, int]]]:
    """Bytes per probe in each interval, in key order."""
    rows = keys
    if half == "lo":
        rows = rows.filter(F.col("hi").isin(sorted({outer for outer, _ in intervals})))
    if before is not None:
        rows = rows.filter(F.shiftright(half, before).isin(sorted({prefix for _, prefix in intervals})))
    outer = F.col("hi") if half == "lo" else F.lit(None).cast("long")
    sums = rows.groupBy(outer.alias("outer"), F.shiftright(half, left).alias("probe")).agg(F.sum("size").alias("bytes"))
    cells: dict[tuple, list[tuple[int, int]]] = {}
    for r in sums.collect():
        prefix = None if before is None else r["probe"] >> (before - left)
        cells.setdefault((r["outer"], prefix), []).append((r["probe"], r["bytes"]))
    return {interval: sorted(found) for interval, found in cells.items()}


def _least(outer: int | None, probe: int, left: int) -> Splitter:
    """The splitter whose shard begins with the first key of ``probe``."""
    value, top = probe << left, (1 << (_WIDTH - 1)) - 1
    if outer is None:
        return Splitter(min(value, top))
    return Splitter(outer, value) if value <= top else Splitter(min(outer + 1, top))


def shard_documents(
    docs: DataFrame, shards: int = 24, tolerance: float = 0.001, rows_per_bin: int = 1_000_000
) -> DataFrame:
    """Every document with its shard and gapless slot, under the ``bytes`` law.

    Returns doc_id, size (UTF-8 bytes and 8), text_crc32, law, shard, slot and grown_shard (null
    under this law). Shards are near equal in bytes; equal texts are neighbours and share a shard
    unless a splitter has to fall among them. A null text has no bytes; null ids and repeated rows
    are rows like others; an empty table gives no rows; other columns are ignored.

    The narrow keys are exchanged once, by (shard, bin): bins cut by the hash of the identity,
    about ``rows_per_bin`` rows each, so neither a large shard nor a hot text lands in one task.
    Slots are the bin's offset and the rank in it.
    """
    keys = stored(keyed(docs))
    cuts = splitters(keys, shards, tolerance)
    shard = sum((c.at_or_below().cast("int") for c in cuts), F.lit(0)).alias("shard")
    bits = max(0, math.ceil(math.log2(max(1, keys.count() / rows_per_bin))))
    place = F.shiftrightunsigned("lo", _WIDTH - bits) if bits else F.lit(0).cast("long")
    placed = keys.select("*", shard, place.alias("bin"))
    offsets = (
        placed.groupBy("shard", "bin")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            "shard",
            "bin",
            "coalesce(sum(n) OVER (PARTITION BY shard ORDER BY bin "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins",
        )
    )
    return placed.join(offsets, ["shard", "bin"]).selectExpr(
        "doc_id",
        "size",
        "text_crc32",
        "'bytes' AS law",
        "shard",
        "begins + row_number() OVER (PARTITION BY shard, bin ORDER BY hi, lo, doc_id) - 1 AS slot",
        "cast(null AS int) AS grown_shard",
    )
