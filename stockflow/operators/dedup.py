"""First-arrival-wins de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_wins(df: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """Keep the earliest row of each ``key``; ``arrival`` must order rows totally.

    The rank filter lets Spark keep one row per key in every map task before the
    shuffle, so even a key holding a third of all rows sends one row per task.
    """
    order = ", ".join(f"{c} ASC NULLS LAST" for c in arrival)
    ranked = df.selectExpr("*", f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rn")
    return ranked.filter("_rn = 1").drop("_rn")


def unseen(
    batch: DataFrame, target: DataFrame, key: str, keys_of: DataFrame | None = None
) -> DataFrame:
    """Rows of ``batch`` whose ``key`` is not in ``target``, which holds each key once.

    The target is narrowed to the batch's keys first, so what meets the batch has at most one row
    per key of it. Which side is sent where is left to Spark, which measures bytes at run time.
    ``keys_of`` gives the keys where they are cheaper to read than from ``batch``.
    """
    keys = (batch if keys_of is None else keys_of).select(key).distinct()
    known = target.select(key).join(keys, key, "left_semi")
    return batch.join(known, key, "left_anti")


def dedup_within_delay(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """Streaming variant with bounded state: repeats later than ``delay`` are not caught."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])
