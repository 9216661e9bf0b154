"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.store import stored


def _mark(edges: DataFrame) -> tuple[int, int]:
    """Number and order-free checksum of the edges."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _least_neighbour(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u and v, bigint).

    The component is its least node. Each round replaces the edges by about as many, written to
    the shared folder; the number of rounds grows with the logarithm of a component's diameter.
    A node of many links is a hot key only in joins, which Spark splits.
    """
    edges = stored(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct()
    )
    mark = _mark(edges)
    while mark[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _least_neighbour(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large)
        least = _least_neighbour(large)
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select("e.u", F.col("e.m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        edges = stored(small)
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
