"""Upsert by unique key and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sync_columns(target: DataFrame, new: DataFrame) -> DataFrame:
    """``target`` in the column set of ``new``: added columns are NULL, removed ones go."""
    have = set(target.columns)
    return target.select(
        *[
            (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in new.schema.fields
        ]
    )


def upsert(target: DataFrame, new: DataFrame, key: str = "event_id") -> DataFrame:
    """All rows of ``new``, which holds each key once, plus the target rows without its keys."""
    kept = sync_columns(target, new).join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new)
