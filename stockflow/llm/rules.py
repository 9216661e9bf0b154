"""Quality rules: base limits and an isolation forest on rule statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm import stats
from stockflow.llm.store import annotate, hash_share, map_arrow, stored

#: About as many rows, labelled or not, fit the forest.
SAMPLE = 20_000
TREES = 128
TREE_ROWS = 256
#: Rejecting a share of the rows labelled good costs as much as keeping so many times that of the bad.
COST = 30.0
MIN_WORDS = 50


@dataclass(frozen=True)
class Forest:
    """Isolation trees in arrays (tree, node): split column (-1: leaf), value, children, path length."""

    column: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    path: np.ndarray
    unit: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """2^(-mean path length / that of a random search): near 1 is anomalous, under 0.5 usual."""
        total = np.zeros(len(rows))
        for t in range(len(self.column)):
            at = np.zeros(len(rows), dtype=np.int64)
            while True:
                column = self.column[t][at]
                inner = column >= 0
                if not inner.any():
                    break
                below = rows[np.arange(len(rows)), np.maximum(column, 0)] < self.value[t][at]
                at = np.where(inner, np.where(below, self.left[t][at], self.right[t][at]), at)
            total += self.path[t][at]
        return 2.0 ** (-total / len(self.column) / self.unit)


def _search_length(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n if n > 2 else float(n == 2)


def fit_forest(rows: np.ndarray, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Trees over random subsets of ``rows``, split at random values of random columns."""
    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1)
    column = np.full((trees, nodes), -1, dtype=np.int64)
    value, path = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    left, right = np.zeros((trees, nodes), dtype=np.int64), np.zeros((trees, nodes), dtype=np.int64)
    for t in range(trees):
        used = 1
        todo = [(0, rows[rng.choice(len(rows), size, replace=False)], 0)]
        while todo:
            node, part, level = todo.pop()
            low, high = part.min(axis=0), part.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level == depth or not len(varied):
                path[t, node] = level + _search_length(len(part))
                continue
            c = rng.choice(varied)
            cut = rng.uniform(low[c], high[c])
            below = part[:, c] < cut
            if not below.any():
                cut = high[c]
                below = part[:, c] < cut
            column[t, node], value[t, node] = c, cut
            left[t, node], right[t, node] = used, used + 1
            todo += [(used, part[below], level + 1), (used + 1, part[~below], level + 1)]
            used += 2
    return Forest(column, value, left, right, path, max(_search_length(size), 1e-9))


@dataclass(frozen=True)
class Model:
    forest: Forest | None
    threshold: float


#: Parts of the range of scores whose counts reach the driver.
BINS = 4096


def _scored(rows: DataFrame, forest: Forest | None) -> DataFrame:
    """``rows`` with ``anomaly``, the forest's score of their statistics."""

    def run(batches):
        for batch in batches:
            values = stats.ratios({c: batch[c].to_numpy(zero_copy_only=False) for c in stats.FIELDS})
            score = forest.score(values) if forest else np.zeros(len(values))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, "anomaly"])

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    return map_arrow(rows, run, f"{schema}, anomaly double")


def threshold(scores: DataFrame, cost: float) -> float:
    """The score from which on to reject: the best share of bad rows less ``cost`` times that of good.

    ``scores`` has anomaly and good of every labelled row. They are counted per score, and summed
    downwards within each of ``BINS`` parts on top of the parts above, so every score is tried.
    """
    per_score = stored(
        scores.groupBy("anomaly").agg(
            F.sum(F.col("good").cast("long")).alias("good"), F.sum((~F.col("good")).cast("long")).alias("bad")
        ).withColumn("bin", F.floor(F.col("anomaly") * BINS).cast("int"))
    )
    bins = per_score.groupBy("bin").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()
    good, bad, above = 0, 0, []
    for r in sorted(bins, key=lambda r: -r["bin"]):
        above.append((r["bin"], good, bad))
        good, bad = good + r["good"], bad + r["bad"]
    if not good or not bad:
        return 2.0
    carried = scores.sparkSession.createDataFrame(above, "bin int, good_above long, bad_above long")
    # At most one row a part.
    rows = per_score.join(F.broadcast(carried), "bin")
    down = "OVER (PARTITION BY bin ORDER BY anomaly DESC)"
    gain = f"(bad_above + sum(bad) {down}) / {bad}D - {cost}D * (good_above + sum(good) {down}) / {good}D"
    best = rows.selectExpr("anomaly", f"{gain} AS gain").agg(F.max(F.struct("gain", "anomaly")).alias("best")).first()[0]
    return float(best["anomaly"]) if best["gain"] > 0 else 2.0


def fit(counted: DataFrame, labels: DataFrame, sample: int = SAMPLE, cost: float = COST) -> Model:
    """The forest from about ``sample`` documents, its threshold from all labelled ones.

    The threshold gives the largest share of the rows labelled bad at or above it, less ``cost``
    times the share of those labelled good; without labels of both kinds nothing is rejected.
    """
    passed = counted.filter("NOT base_failed")
    rows = hash_share(passed, sample, "doc_id", *stats.FIELDS).select("doc_id", *stats.FIELDS).toPandas()
    if len(rows) < 2:
        return Model(None, 2.0)
    rows = rows.sort_values([*stats.FIELDS, "doc_id"])
    forest = fit_forest(stats.ratios({c: rows[c].to_numpy() for c in stats.FIELDS}))
    known = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    held = passed.join(known, "doc_id").select(*stats.FIELDS, (F.col("quality") > 0).alias("good"))
    return Model(forest, threshold(_scored(held, forest).select("anomaly", "good"), cost))


def apply(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, cost: float = COST) -> DataFrame:
    """doc_id, the counts, base_failed, anomaly and kept of every document.

    A document fails the base rules with under ``MIN_WORDS`` words, or if over half of its words
    lie in three-word windows that recur in it. Others are kept while their anomaly (the forest's
    score) is under the threshold. Null texts have no words and fail; null ids, repeated rows and
    ids are rows like others; labels that disagree count as bad; an empty table gives no rows;
    other columns are ignored.
    """
    counted = annotate(docs, ["doc_id"], stats.ddl(), stats.counts).select(
        "row.doc_id",
        *stats.FIELDS,
        F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words").alias("base_failed"),
    )
    counted = stored(counted)
    model = fit(counted, labels, sample, cost)

    return _scored(counted, model.forest).withColumn(
        "kept", ~F.col("base_failed") & (F.col("anomaly") < F.lit(model.threshold))
    )
