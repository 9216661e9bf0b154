"""Toxicity: class-conditional Kneser-Ney models of words with shared backoff counts."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.store import hash_share, map_arrow, stored
from stockflow.llm.words import SPACED, spans, word_hashes

#: Slots of the table of frequent words, a power of two: the size of what is broadcast, whatever the
#: input. Words that have no slot are joined.
SLOTS = 1 << 20
#: Words of the passages whose normalised ratio counts beside that of the whole text.
PASSAGE = 3
#: Words with their texts that a worker gathers before it merges them, and rows of the merged table
#: at which it hands the table on.
GATHERED = 1 << 20
KEPT = 1 << 20
#: Rows of 64 bits in the filter of labelled ids: the size of what is broadcast.
MARKS = 1 << 19
#: Labelled rows that the decision is fitted on, about; their texts are scored by models that were
#: counted without them.
SAMPLE = 20_000
FOLDS = 4
#: Columns of counts: class and fold.
_KINDS = [f"{label}_{fold}" for fold in range(FOLDS) for label in ("ordinary", "toxic")]
#: Bits for each byte that a word may follow.
_CONTEXTS = [f"context_{i}" for i in range(4)]
#: Ratios beyond which a text's words count as evidence of their own.
BEYOND = (2.5, 3.5, 4.5)
MEASURES = ("whole", "peak", "second", "clear", "strong", "sure", "length")


def words_of(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word of a text, in lower case, and the byte before it that ends a word.

    The first word follows a space. Hashes have 64 bits and take every byte of a word.
    """
    data = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    start, end = spans(data, SPACED)
    before = np.full(len(start), 0x20, dtype=np.uint8)
    before[1:] = data[end[:-1] - 1]
    return word_hashes(data, start, end), before


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, contexts, counts by class and fold) of the labelled texts ``docs``: text, label, fold.

    A text counts each of its words once, so that one which repeats itself weighs no more. The
    contexts of a word are the bytes that end the words before it, as a set of 256 bits: exact
    however tasks split the texts. Workers sum what they hold, so the shuffle gets a word once per
    task, or per ``KEPT``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: list[np.ndarray] | None = None
        words, befores, sides, size = [], [], [], 0

        def merged() -> list[np.ndarray]:
            sizes = [len(w) for w in words]
            word, before = np.concatenate(words), np.concatenate(befores)
            text, side = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sides, sizes)
            order = np.lexsort((text, word))
            word, before, text, side = word[order], before[order], text[order], side[order]
            first = (np.diff(word, prepend=word[:1] + np.uint64(1)) != 0) | (np.diff(text, prepend=-1) != 0)
            bits = np.uint64(1) << (before & 63).astype(np.uint64)
            rows = [np.where(before >> 6 == i, bits, np.uint64(0)) for i in range(4)]
            rows += [(first & (side == i)).astype(np.int64) for i in range(len(_KINDS))]
            return _merged([[word, *rows]] + ([table] if table is not None else []))

        for batch in batches:
            for text, label, fold in zip(*[batch[c].to_pylist() for c in ("text", "label", "fold")]):
                found, before = words_of(text)
                if not len(found):
                    continue
                words.append(found)
                befores.append(before)
                sides.append(2 * fold + (label > 0))
                size += len(found)
                if size >= GATHERED:
                    table = merged()
                    words, befores, sides, size = [], [], [], 0
                    if len(table[0]) >= KEPT:
                        yield _row_batch(table)
                        table = None
        if size:
            table = merged()
        if table is not None:
            yield _row_batch(table)

    schema = ", ".join(["word long", *[f"{c} long" for c in _CONTEXTS], *[f"{k} long" for k in _KINDS]])
    counts = map_arrow(docs.select("text", "label", "fold"), run, schema)
    contexts = sum((F.bit_count(F.bit_or(c)) for c in _CONTEXTS), F.lit(0)).cast("long").alias("contexts")
    return counts.groupBy("word").agg(contexts, *[F.sum(k).alias(k) for k in _KINDS])


def _merged(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One row per word: the union of its contexts and the sums of its counts."""
    columns = [np.concatenate([p[i] for p in parts]) for i in range(len(parts[0]))]
    order = np.argsort(columns[0], kind="stable")
    word = columns[0][order]
    new = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    unions = [np.bitwise_or.reduceat(c[order], new) for c in columns[1:5]]
    return [word[new], *unions, *[np.add.reduceat(c[order], new) for c in columns[5:]]]


def _row_batch(table: list[np.ndarray]) -> pa.RecordBatch:
    whole = [c.view(np.int64) if c.dtype == np.uint64 else c for c in table]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in whole], ["word", *_CONTEXTS, *_KINDS])


@dataclass(frozen=True)
class Side:
    """What a class's model takes from its counts: their sum, the discounts of words that it has
    once, twice and more often, and the mass that these free."""

    total: float
    discounts: tuple[float, float, float]
    mass: float

    @property
    def weight(self) -> float:
        """The share of the backoff."""
        return self.mass / self.total if self.total else 1.0

    def kept(self, n: F.Column) -> F.Column:
        """The share of a word's own count, less its discount."""
        once, twice, more = self.discounts
        discount = F.when(n == 1, once).when(n == 2, twice).otherwise(F.when(n > 2, more).otherwise(0.0))
        return (n - discount) / (self.total or 1.0)


def discounts(kinds: list[int]) -> tuple[float, float, float]:
    """Discounts from how many words are counted once, twice, three and four times."""
    base = kinds[0] / (kinds[0] + 2 * kinds[1]) if kinds[0] else 0.5
    found = [k - (k + 1) * base * kinds[k] / kinds[k - 1] if kinds[k - 1] else 0.5 * k for k in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1))


def _side(folds: list[int], label: str) -> F.Column:
    return sum((F.col(f"{label}_{f}") for f in folds), F.lit(0))


def fit_sides(counts: DataFrame, models: list[list[int]]) -> tuple[list[tuple[Side, Side]], float]:
    """(toxic, ordinary) of each list of folds, and the number of contexts of all words.

    The discounts of a class come from its own counts of counts.
    """
    sums = [F.sum("contexts").alias("contexts")]
    for i, folds in enumerate(models):
        for label in ("toxic", "ordinary"):
            n = _side(folds, label)
            sums += [F.sum(n).alias(f"{label}{i}")]
            sums += [F.sum((n == k).cast("long")).alias(f"{label}{i}_{k}") for k in (1, 2, 3, 4)]
            sums += [F.sum((n > 0).cast("long")).alias(f"{label}{i}_any")]
    row = counts.agg(*sums).first()
    sides = []
    for i in range(len(models)):
        pair = []
        for label in ("toxic", "ordinary"):
            kinds = [row[f"{label}{i}_{k}"] or 0 for k in (1, 2, 3, 4)]
            once, twice, more = freed = discounts(kinds)
            rest = (row[f"{label}{i}_any"] or 0) - kinds[0] - kinds[1]
            mass = once * kinds[0] + twice * kinds[1] + more * rest
            pair.append(Side(float(row[f"{label}{i}"] or 0), freed, mass))
        sides.append(tuple(pair))
    return sides, float(row["contexts"] or 1)


def fit_ratios(counts: DataFrame, models: list[list[int]], slots: int = SLOTS) -> tuple[DataFrame, list[float]]:
    """(slot, word, ratios, best, low, high): log-likelihood ratio toxic to ordinary by model, and of unseen words.

    Interpolated Kneser-Ney with the class as history: a class's probability of a word is its
    discounted share of the class's counts plus the mass so freed times the backoff. The backoff is
    shared: it counts the distinct contexts of a word in both classes together, so what a class has
    rarely or not at all is smoothed by what the word does elsewhere. A word that a model has in
    neither class has the same backoff in both, so its ratio is that of the freed masses. ``best``
    is the word of highest count of its slot; the bits of ``low`` and ``high`` are set for the others.
    """
    sides, contexts = fit_sides(counts, models)
    backoff = F.col("contexts") / F.lit(contexts)
    ratios, unseen = [], []
    for folds, pair in zip(models, sides):
        chances, seen = [], F.lit(0)
        for side, label in zip(pair, ("toxic", "ordinary")):
            n = _side(folds, label)
            seen = seen + n
            chances.append(side.kept(n) + F.lit(side.weight) * backoff)
        unseen.append(float(np.log(max(pair[0].weight, 1e-12)) - np.log(max(pair[1].weight, 1e-12))))
        ratios.append(F.when(seen > 0, F.log(chances[0]) - F.log(chances[1])).otherwise(F.lit(unseen[-1])).cast("float"))
    every = sum((F.col(k) for k in _KINDS), F.lit(0)).cast("long").alias("n")
    bits = slots.bit_length() - 1
    slot = F.shiftrightunsigned("word", 64 - bits).cast("int").alias("slot")
    mark = F.shiftrightunsigned("word", 64 - bits - 7).bitwiseAND(F.lit(127)).cast("int").alias("mark")
    table = counts.select(slot, mark, "word", every, F.array(*ratios).alias("ratios"))
    rank = Window.partitionBy("slot").orderBy(F.desc("n"), "word")
    table = table.withColumn("best", F.row_number().over(rank) == 1)
    site = Window.partitionBy("slot")
    marks = []
    for name, first in (("low", 0), ("high", 64)):
        inside = (~F.col("best")) & F.col("mark").between(first, first + 63)
        bit = F.when(inside, F.expr(f"shiftleft(1L, mark - {first})")).otherwise(F.lit(0).cast("long"))
        marks.append(F.bit_or(bit).over(site).alias(name))
    return table.select("slot", "word", "ratios", "best", *marks), unseen


@dataclass(frozen=True)
class Frequent:
    """The word of highest count of each slot (0: none), with its ratios by model."""

    word: np.ndarray
    ratios: np.ndarray
    #: 128 bits a slot: those of the next bits of the other words' hashes are set.
    low: np.ndarray
    high: np.ndarray
    #: Ratio of a word that no text of the model has, by model.
    unseen: np.ndarray

    def __getstate__(self) -> dict[str, tuple]:
        """Deflated: every executor keeps what is broadcast on its disk."""
        return {k: (v.dtype, v.shape, zlib.compress(v.tobytes(), 1)) for k, v in vars(self).items()}

    def __setstate__(self, state: dict[str, tuple]) -> None:
        for k, (kind, shape, data) in state.items():
            object.__setattr__(self, k, np.frombuffer(zlib.decompress(data), dtype=kind).reshape(shape))

    def find(self, words: np.ndarray, model: int) -> tuple[np.ndarray, np.ndarray]:
        """The ratio of each word, and for which words it is not at hand.

        Of the words that are not in their slot the bits tell most that no text has.
        """
        bits = len(self.word).bit_length() - 1
        slot = (words >> np.uint64(64 - bits)).astype(np.int64)
        mark = (words >> np.uint64(64 - bits - 7)) & np.uint64(127)
        hit = self.word[slot] == words
        ratio = np.where(hit, self.ratios[model][slot], self.unseen[model]).astype(np.float64)
        marks = np.where(mark < 64, self.low[slot], self.high[slot]) >> (mark & np.uint64(63))
        return ratio, ~hit & ((marks & np.uint64(1)) == 1)


def frequent(ratios: DataFrame, unseen: list[float], slots: int = SLOTS) -> Frequent:
    """The word of highest count of each slot; at most one row per slot reaches the driver."""
    lists = [F.col("ratios")[i].alias(f"ratio{i}") for i in range(len(unseen))]
    found = ratios.filter("best").select("slot", "word", "low", "high", *lists).toArrow()
    slot = found["slot"].to_numpy()
    word, low, high = (np.zeros(slots, dtype=np.uint64) for _ in range(3))
    for name, column in (("word", word), ("low", low), ("high", high)):
        column[slot] = found[name].to_numpy().view(np.uint64)
    table = np.zeros((len(unseen), slots), dtype=np.float32)
    for i in range(len(unseen)):
        table[i, slot] = found[f"ratio{i}"].to_numpy()
    return Frequent(word, table, low, high, np.array(unseen))


def _passages(values: np.ndarray, size: int) -> np.ndarray:
    """Sums of ``size`` consecutive values."""
    return np.sum([values[k : len(values) - size + 1 + k] for k in range(size)], axis=0)


def _beyond(values: np.ndarray) -> list[float]:
    return [float(np.maximum(values - b, 0).sum()) for b in BEYOND]


def partial(text: str | None, table: Frequent, model: int, passage: int = PASSAGE) -> dict:
    """What the measures of a text need, without the ratios of words that are not at hand.

    ``words`` are those, in order, ``near`` the places of the words in passages with one, with
    their ``values`` (NaN: not at hand), ``over`` the distinct words' sums beyond each of ``BEYOND``.
    Of the other passages the highest are enough, as many as can overlap one passage and one more.
    """
    words, _ = words_of(text)
    if not len(words):
        return {"n": 0, "total": 0.0, "over": [0.0] * len(BEYOND), "tops": [], "sums": [], "near": [], "values": [], "words": []}
    values, lacks = table.find(words, model)
    once = np.unique(words, return_index=True)[1]
    over = _beyond(values[once][~lacks[once]])
    size = min(passage, len(words))
    sums = _passages(values, size)
    missing = np.flatnonzero(lacks)
    if not len(missing):
        tops = np.argsort(-sums, kind="stable")[: 2 * size]
        return {"n": len(words), "total": values.sum(), "over": over, "tops": tops, "sums": sums[tops], "near": [], "values": [], "words": []}
    near = np.unique((missing[:, None] + np.arange(1 - size, size)).clip(0, len(words) - 1))
    whole = np.flatnonzero(_passages(lacks.astype(np.int64), size) == 0)
    tops = whole[np.argsort(-sums[whole], kind="stable")[: 2 * size]]
    return {
        "n": len(words),
        "total": values[~lacks].sum(),
        "over": over,
        "tops": tops,
        "sums": sums[tops],
        "near": near,
        "values": np.where(lacks, np.nan, values)[near],
        "words": words[missing].view(np.int64),
    }


def finished(row: dict, ratios: dict[int, float], unseen: float, passage: int = PASSAGE) -> tuple[float, ...]:
    """Mean ratio per word of the whole text, the two highest of separate passages, logs of what its
    distinct words have beyond each of ``BEYOND``, log of words.

    ``row`` is a ``partial`` one, ``ratios`` has those of the words it lacks that some text has.
    """
    n = row["n"]
    if not n:
        return (0.0,) * len(MEASURES)
    size = min(passage, n)
    at, sums, total = np.array(row["tops"], dtype=np.int64), np.array(row["sums"], dtype=np.float64), row["total"]
    over = np.array(row["over"])
    if row["words"]:
        over = over + _beyond(np.array([ratios.get(w, unseen) for w in set(row["words"])]))
        near, values = np.array(row["near"], dtype=np.int64), np.array(row["values"], dtype=np.float64)
        found = np.array([ratios.get(w, unseen) for w in row["words"]])
        values[np.isnan(values)] = found
        total += found.sum()
        joined = np.flatnonzero(near[size - 1 :] - near[: len(near) - size + 1] == size - 1)
        at, sums = np.concatenate([at, near[joined]]), np.concatenate([sums, _passages(values, size)[joined]])
    best = np.lexsort((at, -sums))[0]
    apart = sums[np.abs(at - at[best]) >= size]
    second = float(apart.max()) / passage if len(apart) else 0.0
    return total / n, sums[best] / passage, second, *np.log1p(over).tolist(), float(np.log1p(n))


_PARTIAL = {
    "n": "int",
    "total": "double",
    "over": "array<double>",
    "tops": "array<int>",
    "sums": "array<double>",
    "near": "array<int>",
    "values": "array<float>",
    "words": "array<long>",
}


def _measured(docs: DataFrame, keep: list[str], ratios: DataFrame, shared) -> DataFrame:
    """``keep``, ``model`` and the measures of every text by its model; ``shared`` broadcasts the frequent words.

    Texts are read once, for their partial measures. Words that have no slot are looked up once
    each, by their hash, whatever the number of texts that hold them and the length of the word,
    and brought back to their texts.
    """

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = {"int": pa.int32(), "float": pa.float32(), "double": pa.float64(), "long": pa.int64()}
        types.update({f"array<{k}>": pa.list_(t) for k, t in types.items()})
        for batch in batches:
            rows = [partial(t, shared.value, m) for t, m in zip(batch["text"].to_pylist(), batch["model"].to_pylist())]
            columns = [pa.array([r[c] for r in rows], types[k]) for c, k in _PARTIAL.items()]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in [*keep, "model"]], *columns], [*keep, "model", *_PARTIAL])

    def end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unseen = shared.value.unseen.tolist()
        for batch in batches:
            parts = zip(*[batch[c].to_pylist() for c in _PARTIAL])
            found = [{f["word"]: f["ratio"] for f in some or []} for some in batch["found"].to_pylist()]
            models = batch["model"].to_pylist()
            rows = [finished(dict(zip(_PARTIAL, part)), some, unseen[m]) for part, some, m in zip(parts, found, models)]
            columns = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(MEASURES))]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in [*keep, "model"]], *columns], [*keep, "model", *MEASURES])

    kinds = dict(docs.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep)
    added = ", ".join(f"{c} {k}" for c, k in _PARTIAL.items())
    begun = map_arrow(docs.select(*keep, "model", "text"), begin, f"{schema}, model {kinds['model']}, {added}")
    begun = stored(begun.withColumn("row", F.monotonically_increasing_id()))
    lacking = begun.select("row", "model", F.explode(F.array_distinct("words")).alias("word"))
    rare = ratios.filter("NOT best").select("word", "ratios")
    rare = rare.join(lacking.select("word").distinct(), "word", "left_semi")
    found = lacking.join(rare, "word").select("row", F.struct("word", F.expr("ratios[model]").alias("ratio")).alias("found"))
    found = stored(found.groupBy("row").agg(F.collect_list("found").alias("found")))
    # Texts that lack nothing do not go through the join.
    whole = begun.filter("size(words) = 0").withColumn("found", F.lit(None).cast(dict(found.dtypes)["found"]))
    parts = begun.filter("size(words) > 0").join(found, "row", "left").select(*whole.columns).unionByName(whole)
    measures = ", ".join(f"{m} double" for m in MEASURES)
    return map_arrow(parts.select(*keep, "model", *_PARTIAL, "found"), end, f"{schema}, model {kinds['model']}, {measures}")


@dataclass(frozen=True)
class Decision:
    """Logistic regression on the measures."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def score(self) -> F.Column:
        total = F.lit(float(self.weights[0]))
        for name, m, s, w in zip(MEASURES, self.mean, self.scale, self.weights[1:]):
            total = total + F.lit(float(w)) * F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col(name) - float(m)) / float(s)))
        return 1 / (1 + F.exp(-total))


def fit_decision(rows: np.ndarray, toxic: np.ndarray, ridge: float = 0.1) -> Decision:
    """Newton's method with each class weighted to one half; without two classes nothing is toxic."""
    size = len(MEASURES)
    if not len(rows) or toxic.all() or not toxic.any():
        return Decision(np.zeros(size), np.ones(size), np.array([-4.0, *[0.0] * size]))
    mean, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    x = np.concatenate([np.ones((len(rows), 1)), np.clip((rows - mean) / scale, -8, 8)], axis=1)
    share = np.where(toxic, 0.5 / toxic.sum(), 0.5 / (~toxic).sum()) * len(rows)
    penalty = np.array([1e-6, *[ridge] * size])
    w = np.zeros(1 + size)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, x.T @ (share * (toxic - p)) - penalty * w)
        w = w + step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return Decision(mean, scale, w)


def _marked(docs: DataFrame, known: DataFrame, marks: int = MARKS) -> DataFrame:
    """Rows of ``docs`` whose id may be among the known: the join that follows shuffles few others.

    Each known id sets one of ``64 * marks`` bits, a row per 64 of them, whatever their number.
    """
    row, bit = F.pmod(F.xxhash64("doc_id"), F.lit(marks)), F.expr("shiftleft(1L, cast(pmod(hash(doc_id), 64) AS int))")
    there = known.groupBy(row.alias("mark")).agg(F.bit_or(bit).alias("bits"))
    return docs.withColumn("mark", row).join(F.broadcast(there), "mark").filter(F.col("bits").bitwiseAND(bit) != 0).select(*docs.columns)


def score(docs: DataFrame, labels: DataFrame, slots: int = SLOTS, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Rows whose crc32 of the doc_id as text is a multiple of five are held out: their labels are
    never read. The others' words are all counted. A text's measures are its mean ratio and those
    of its two most toxic passages, so that a long text does not dilute a few words. The decision
    on them is fitted on about ``sample`` labelled rows, each measured with the counts of the
    other fold; the final models have all counts. Only the text enters a score. ``slots`` bounds
    what is broadcast and changes no score.

    A null doc_id is not held out and has no label; labels that disagree count as toxic; null and
    empty texts get the score of no evidence; rows that repeat are scored alike; an empty table
    gives no rows; other columns are ignored.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(rest != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("long").alias("label"))
        .withColumn("fold", F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)))
    )
    learnt = _marked(docs.select("doc_id", "text"), known).join(known, "doc_id").select("text", "label", "fold")
    sc = docs.sparkSession.sparkContext
    folds = list(range(FOLDS))
    models = [*[[f for f in folds if f != fold] for fold in folds], folds]
    table, unseen = fit_ratios(stored(word_counts(learnt)), models, slots)
    ratios = stored(table)
    shared = sc.broadcast(frequent(ratios, unseen, slots))
    chosen = hash_share(known, sample, "doc_id")
    texts, last = docs.select("doc_id", "text"), len(models) - 1
    fitted = texts.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label", F.col("fold").cast("int").alias("model"))
    every = texts.select("*", F.lit(None).cast("long").alias("label"), F.lit(last).alias("model"))
    measured = stored(_measured(every.unionByName(fitted), ["doc_id", "label"], ratios, shared))
    held = measured.filter(F.col("model") < last).toPandas()
    decision = fit_decision(held[list(MEASURES)].to_numpy(), held["label"].to_numpy() > 0)
    scored = measured.filter(F.col("model") == last)
    return scored.select(
        "doc_id",
        F.coalesce(rest == 0, F.lit(False)).alias("held_out"),
        decision.score().alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
