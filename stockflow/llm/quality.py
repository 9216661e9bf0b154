"""Quality classifier: document evidence with host and path posteriors by empirical Bayes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm import stats
from stockflow.llm.store import annotate, hash_share, stored
from stockflow.llm.words import SPACED, byte_rows, lower, spans, word_hashes

#: Labelled rows that the document classifier is fitted on, about.
SAMPLE = 50_000
#: Buckets of words, a power of two, whose shares of a text are features beside its statistics.
BUCKETS = 128
#: Parts of the documents; the sites' rates for one part come from the others.
FOLDS = 8
#: Weight of a document without a label, whose class is only estimated, in its site's rate.
SOFT = 0.25
KEEP = 0.5
_LIMIT = 12.0


def word_shares(texts: pa.Array) -> np.ndarray:
    """For each text the root of the share of its words in each bucket of their hashes."""
    out = np.zeros((len(texts), BUCKETS), dtype=np.float32)
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    for i, raw in enumerate(byte_rows(texts)):
        text = lower(raw)
        words = word_hashes(text, *spans(text, SPACED))
        if len(words):
            out[i] = np.sqrt(np.bincount((words >> shift).astype(np.int64), minlength=BUCKETS) / len(words))
    return out


@dataclass(frozen=True)
class Evidence:
    """Logistic regression on text statistics and words; ``prior`` is the log-odds of its training rows."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def of(self, counts: dict[str, np.ndarray], shares: np.ndarray) -> np.ndarray:
        """Log-likelihood ratio good to bad, without the training rows' prior."""
        x = _terms((_raw(counts, shares) - self.mean) / self.scale)
        return np.clip(x @ self.weights - self.prior, -_LIMIT, _LIMIT)


def _raw(counts: dict[str, np.ndarray], shares: np.ndarray) -> np.ndarray:
    return np.concatenate([stats.ratios(counts), shares], axis=1)


def _terms(x: np.ndarray) -> np.ndarray:
    """A constant, the statistics and their squares, so that both ends may be bad, and the words."""
    x = np.clip(x, -8, 8)
    some = x[:, : len(stats.RATIOS)]
    return np.concatenate([np.ones((len(x), 1)), some, some * some, x[:, len(stats.RATIOS) :]], axis=1)


def fit_evidence(
    counts: dict[str, np.ndarray], shares: np.ndarray, good: np.ndarray, ridge: float = 1.0, words_ridge: float = 50.0
) -> Evidence:
    """Newton's method with a ridge on all but the constant; one class alone gives no evidence."""
    raw = _raw(counts, shares)
    rate = float(np.clip(good.mean(), 1e-3, 1 - 1e-3)) if len(good) else 0.5
    prior = float(np.log(rate / (1 - rate)))
    if len(good) == 0 or good.all() or not good.any():
        weights = np.zeros(_terms(raw[:0]).shape[1])
        weights[0] = prior
        return Evidence(np.zeros(raw.shape[1]), np.ones(raw.shape[1]), weights, prior)
    mean, scale = raw.mean(axis=0), raw.std(axis=0) + 1e-9
    x = _terms((raw - mean) / scale)
    penalty = np.full(x.shape[1], ridge)
    penalty[-shares.shape[1] :] = words_ridge
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (good - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Evidence(mean, scale, w, prior)


def _fit(docs: DataFrame, labels: DataFrame, sample: int) -> Evidence:
    """The classifier from about ``sample`` labelled rows, those of the least hash.

    That bound makes the ids safe to broadcast.
    """
    taken = hash_share(_known(labels), sample, "doc_id")
    rows = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")

    def compute(texts: pa.Array) -> dict[str, object]:
        return {**stats.counts(texts), "shares": list(word_shares(texts))}

    counted = annotate(rows, ["quality"], f"{stats.ddl()}, shares array<float>", compute)
    found = counted.select("row.quality", *stats.FIELDS, "shares").toArrow()
    columns = {c: found[c].to_numpy() for c in stats.FIELDS}
    shares = found["shares"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, BUCKETS)
    return fit_evidence(columns, shares, found["quality"].to_numpy() > 0)


def _known(labels: DataFrame) -> DataFrame:
    return labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(
        F.min("quality").alias("quality")
    )


def _evidence(docs: DataFrame, keep: list[str], model: Evidence) -> DataFrame:
    def compute(texts: pa.Array) -> dict[str, object]:
        columns = {c: np.array(v) for c, v in stats.counts(texts).items()}
        return {"evidence": model.of(columns, word_shares(texts))}

    return annotate(docs, keep, "evidence double", compute)


def _strength(table: DataFrame, rate: str, around: str) -> float:
    """Beta prior strength by moments: how many documents a parent's rate is worth to its children.

    The rates' weighted variance beyond what sampling explains is the spread between sites.
    """
    row = table.selectExpr(
        "sum(n) AS n",
        f"sum(n * pow({rate} - {around}, 2)) AS spread",
        f"sum({around} * (1 - {around})) AS noise",
        f"sum(n * {around} * (1 - {around})) AS scale",
    ).first()
    if not row["n"] or not row["scale"]:
        return 1.0
    between = (row["spread"] - row["noise"]) / row["n"]
    within = row["scale"] / row["n"]
    return float(np.clip(within / max(between, 1e-9) - 1, 1.0, 1e6))


def fold(doc_id: str = "doc_id") -> F.Column:
    """The part of the documents that a row belongs to."""
    return F.pmod(F.xxhash64(F.col(doc_id)), F.lit(FOLDS)).cast("int").alias("fold")


def site_priors(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, path, fold, prior): for each part of a path's documents the rate of good ones in the others.

    A labelled document counts with its label, another with its estimated probability and the
    weight ``SOFT``, for the priors of all parts but its own: no document's evidence or label comes
    back to it. Rates shrink from path to host to the whole by strengths that the tables
    themselves give, so a path with few documents stays near its host, and a host with few near
    the rest. All sums are grouped aggregates, combined before the shuffle.
    """
    rows = scored.join(_known(labels), "doc_id", "left")
    total = _known(labels).agg(F.avg((F.col("quality") > 0).cast("double"))).first()[0]
    base = float(np.clip(0.5 if total is None else total, 1e-3, 1 - 1e-3))
    odds = float(np.log(base / (1 - base)))
    weight = F.when(F.col("quality").isNotNull(), F.lit(1.0)).otherwise(F.lit(SOFT))
    guess = 1 / (1 + F.exp(-(F.col("evidence") + odds)))
    value = F.coalesce((F.col("quality") > 0).cast("double"), guess)
    parts = stored(
        rows.groupBy("host", "path", fold()).agg(F.sum(weight).alias("n"), F.sum(weight * value).alias("s"))
    )
    sums = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    paths, hosts = parts.groupBy("host", "path").agg(*sums), parts.groupBy("host").agg(*sums)
    whole = parts.agg(F.sum("s") / F.sum("n")).first()[0]
    whole = float(np.clip(0.5 if whole is None else whole, 1e-3, 1 - 1e-3))
    host_strength = _strength(hosts.withColumn("rate", F.col("s") / F.col("n")), "rate", f"{whole!r}D")

    def shrunk(s: F.Column, n: F.Column, strength: float, around: F.Column) -> F.Column:
        return (s + strength * around) / (n + strength)

    rated = hosts.select("host", shrunk(F.col("s"), F.col("n"), host_strength, F.lit(whole)).alias("host_rate"))
    rates = paths.join(rated, "host").withColumn("rate", F.col("s") / F.col("n"))
    path_strength = _strength(rates, "rate", "host_rate")

    def others(table: DataFrame, site: list[str], name: str) -> DataFrame:
        """Sums of a site without one part; a site has at most ``FOLDS`` rows."""
        over = Window.partitionBy(*site)
        left = [(F.sum(c).over(over) - F.col(c)).alias(f"{name}_{c}") for c in ("n", "s")]
        return table.select(*site, "fold", *left)

    host_parts = others(parts.groupBy("host", "fold").agg(*sums), ["host"], "host")
    joined = others(parts, ["host", "path"], "path").join(host_parts, ["host", "fold"])
    host_rate = shrunk(F.col("host_s"), F.col("host_n"), host_strength, F.lit(whole))
    prior = shrunk(F.col("path_s"), F.col("path_n"), path_strength, host_rate)
    bounded = F.greatest(F.lit(1e-3), F.least(F.lit(1 - 1e-3), prior))
    return joined.select("host", "path", "fold", bounded.alias("prior"))


def _posterior() -> list:
    odds = F.col("evidence") + F.log(F.col("prior") / (1 - F.col("prior")))
    posterior = 1 / (1 + F.exp(-odds))
    return [posterior.alias("posterior"), (posterior >= KEEP).alias("kept")]


def classify(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """doc_id, host, path, evidence, prior, posterior and kept of every document.

    ``evidence`` is the text's log-likelihood ratio, ``prior`` its path's rate by other documents,
    ``posterior`` the probability that the document is good. Null hosts and paths are empty ones; null texts have
    no words; rows that repeat are judged alike; labels that disagree count as bad; without
    labels of both kinds there is no evidence and all stay; an empty table gives no rows; other
    columns are ignored.
    """
    scored, priors, _ = _scored(docs, labels, host, path, sample)
    judged = scored.withColumn("fold", fold()).join(priors, ["host", "path", "fold"])
    return judged.select("doc_id", "host", "path", "evidence", "prior", *_posterior())


def _scored(
    docs: DataFrame, labels: DataFrame, host: str, path: str, sample: int
) -> tuple[DataFrame, DataFrame, Evidence]:
    model = _fit(docs, labels, sample)
    named = docs.select("doc_id", "text", *[F.coalesce(c, F.lit("")).alias(n) for c, n in ((host, "host"), (path, "path"))])
    scored = stored(_evidence(named, ["doc_id", "host", "path"], model).select("row.*", "evidence"))
    return scored, site_priors(scored, labels), model


def keep_good(
    docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang", sample: int = SAMPLE
) -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, all columns unchanged.

    The evidence is computed anew for each row beside its columns, so that rows need no key.
    """
    _, priors, model = _scored(docs, labels, host, path, sample)
    rows = _evidence(docs, docs.columns, model).select(
        "row",
        "evidence",
        F.coalesce(F.col(f"row.`{host}`"), F.lit("")).alias("host"),
        F.coalesce(F.col(f"row.`{path}`"), F.lit("")).alias("path"),
        fold("row.doc_id"),
    )
    return rows.join(priors, ["host", "path", "fold"]).filter(_posterior()[1]).select("row.*")
