"""Source divergence audit: how the terms of each source differ from its language's."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.store import map_arrow, stored
from stockflow.llm.words import byte_rows

LEAST_DOCS = 10
RANKS = 10
SCALE = 1_000_000_000
#: Bytes of a text that are split into terms at a time.
PIECE = 1 << 20
#: Distinct (group, term) counts that a task gathers before it hands them on.
GATHERED = 300_000
#: Cells of a block of terms by sources.
CELLS = 1 << 20
#: Rows that a task gathers before it thins its skybands anew.
THINNED = 100_000
#: Parts in which a group's skybands are merged.
SALTS = 8

#: What is no letter becomes a space, A-Z becomes a-z; all bytes beyond ASCII stay.
_LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def _terms(text: np.ndarray) -> Counter:
    """The terms of a text; long texts are cut between terms."""
    data = text.tobytes().translate(_LETTERS)
    if len(data) <= PIECE:
        return Counter(data.split())
    counts: Counter = Counter()
    at = 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        counts.update(data[at:end].split())
        at = end + 1
    return counts


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed within tasks only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flushed() -> pa.RecordBatch:
            groups = [(k, n, d) for k, (n, d) in gathered.items()]
            sizes = [len(n) for _, n, _ in groups]
            at = pa.array(np.repeat(np.arange(len(groups)), sizes))
            columns = [pa.array([k[i] for k, _, _ in groups], pa.string()).take(at) for i in range(2)]
            columns.append(pa.array([w for _, n, _ in groups for w in n], pa.binary()).cast(pa.string()))
            columns.append(pa.array([c for _, n, _ in groups for c in n.values()], pa.int64()))
            columns.append(pa.array([d[w] for _, n, d in groups for w in n], pa.int64()))
            gathered.clear()
            return pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        size = 0
        for batch in batches:
            names = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
            for name, text in zip(names, byte_rows(batch["text"])):
                found = _terms(text)
                if not found:
                    continue
                n, d = gathered.setdefault(name, (Counter(), Counter()))
                before = len(n)
                n.update(found)
                d.update(found.keys())
                size += len(n) - before
                if size >= GATHERED:
                    yield flushed()
                    size = 0
        yield flushed()

    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    return map_arrow(docs.select(*plain), run, "lang string, source string, term string, n long, docs long")


def _share(count: str, total: str, terms: str) -> str:
    """p of a count, exactly."""
    top = f"CAST({SCALE} AS DECIMAL(38,0)) * (CAST({count} AS DECIMAL(20,0)) + 2)"
    bottom = f"(CAST({total} AS DECIMAL(20,0)) + 2 * CAST({terms} AS DECIMAL(17,0)))"
    return f"(1 + (({top}) div {bottom}))"


def _gap(p: str, q: str) -> str:
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def _gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _shared_terms(rows: DataFrame) -> DataFrame:
    """(lang, one, other, extra): what terms that both sources of a pair have add to its value.

    ``rows`` has a term per row with the sources that have it, their p and the p of a term they
    lack. A pair's value is otherwise a sum over each source's own terms, as if the other had none
    of them; ``extra`` mends that. Tasks hold blocks of terms by sources and sum within a block.
    """

    def blocks(line: np.ndarray, place: np.ndarray, own: np.ndarray, lack: np.ndarray) -> Iterator[tuple]:
        places, inverse = np.unique(place, return_inverse=True)
        base = np.empty(len(places), dtype=np.int64)
        base[inverse] = lack
        line = np.unique(line, return_inverse=True)[1]
        lines = int(line[-1]) + 1
        high = max(1, CELLS // len(places))
        for a in range(0, lines, high):
            inside = slice(*np.searchsorted(line, [a, a + high]).tolist())
            p = np.tile(base, (min(high, lines - a), 1))
            p[line[inside] - a, inverse[inside]] = own[inside]
            for i in range(len(places) - 1):
                x, y, bx, by = p[:, i : i + 1], p[:, i + 1 :], base[i], base[i + 1 :]
                extra = (_gaps(x, y) - _gaps(x, by) - _gaps(bx, y)).sum(axis=0) + len(p) * _gaps(bx, by)
                found = np.flatnonzero(extra)
                yield np.full(len(found), places[i]), places[i + 1 + found], extra[found]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = batch["entries"]
            size = np.diff(entries.offsets.to_numpy())
            line = np.repeat(np.arange(len(size)), size)
            place, own, lack = (entries.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("place", "p", "b"))
            langs = batch["lang"].dictionary_encode()
            number = langs.indices.to_numpy()[line]
            for n, lang in enumerate(langs.dictionary.to_pylist()):
                its = number == n
                for columns in blocks(line[its], place[its], own[its], lack[its]) if its.any() else ():
                    arrays = [pa.array([lang] * len(columns[0]), pa.string()), *map(pa.array, columns)]
                    yield pa.RecordBatch.from_arrays(arrays, ["lang", "one", "other", "extra"])

    found = map_arrow(rows.select("lang", "entries"), run, "lang string, one long, other long, extra long")
    return found.groupBy("lang", "one", "other").agg(F.sum(F.col("extra").cast("decimal(38,0)")).alias("extra"))


def thin(terms: list[bytes], count: np.ndarray, whole: np.ndarray, k: int) -> np.ndarray:
    """Places of the terms of one group that fewer than ``k`` others dominate.

    A term dominates another if its group count is no lower, its language count no higher and its
    UTF-8 earlier. It then comes first in any ranking by divergence, so the first ``k`` are here.
    Terms are taken in their order; only kept ones need be asked, as every term that ``k`` others
    dominate is dominated by ``k`` kept ones.
    """
    order = np.array(sorted(range(len(terms)), key=terms.__getitem__), dtype=np.int64)
    cell = np.lexsort((np.arange(len(order)), whole[order], count[order]))
    a, b = count[order][cell], whole[order][cell]
    first = np.flatnonzero(np.append(True, (np.diff(a) != 0) | (np.diff(b) != 0)))
    rank = np.arange(len(cell)) - np.repeat(first, np.diff(first, append=len(cell)))
    order = order[np.sort(cell[rank < k])]
    kept = np.empty(len(order), dtype=np.int64)
    counts, wholes = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
    n = 0
    for at, a, b in zip(order.tolist(), count[order].tolist(), whole[order].tolist()):
        if n < k or np.count_nonzero((counts[:n] >= a) & (wholes[:n] <= b)) < k:
            kept[n], counts[n], wholes[n] = at, a, b
            n += 1
    return np.sort(kept[:n])


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The rows (lang, source, term, n, whole) that stay in the skyband of their group's rows in a partition.

    A task keeps the skybands alone, whatever the number of rows it reads.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple, list[list]] = {}

        def thinned(key: tuple) -> list[list]:
            terms, n, whole = groups[key]
            keep = thin(terms, np.array(n, np.int64), np.array(whole, np.int64), k).tolist()
            groups[key] = [[column[i] for i in keep] for column in (terms, n, whole)]
            return groups[key]

        held, limit = 0, THINNED
        for batch in batches:
            names = zip(batch["lang"].to_pylist(), batch["source"].to_pylist())
            values = zip(batch["term"].cast(pa.binary()).to_pylist(), batch["n"].to_pylist(), batch["whole"].to_pylist())
            for key, row in zip(names, values):
                for column, value in zip(groups.setdefault(key, [[], [], []]), row):
                    column.append(value)
            held += batch.num_rows
            if held > limit:
                held = sum(len(thinned(key)[0]) for key in list(groups))
                limit = THINNED + 2 * held
        for key in list(groups):
            terms, n, whole = thinned(key)
            names = [pa.array([part] * len(n), pa.string()) for part in key]
            numbers = [pa.array(n, pa.int64()), pa.array(whole, pa.int64())]
            columns = [*names, pa.array(terms, pa.binary()).cast(pa.string()), *numbers]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "whole"])

    return map_arrow(
        rows.select("lang", "source", "term", "n", "whole"),
        run,
        "lang string, source string, term string, n long, whole long",
    )


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, ranks: int = RANKS) -> DataFrame:
    """lang, source, part, item, value and rank of every (lang, source) group.

    Part ``pair`` ranks the other sources of the language by their summed divergence, part ``term``
    the ``ranks`` terms that most set the group apart. Null text, lang and source are empty; rows
    without an id or with a repeated one count like others; an empty table gives no rows; other
    columns are ignored.

    Counts are summed in tasks, then by (lang, term) in one shuffle. A pair's value comes from each
    source's histogram of shares and from blocks of the terms that both have, never from pairs of
    rows. For the terms each partition keeps the skyband of every group, skybands are merged in
    salted parts, and what stays is ranked by the exact value.
    """
    counts = term_counts(docs).repartition("lang", "term")
    each = counts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = stored(
        each.groupBy("lang", "term")
        .agg(F.collect_list(F.struct("source", "n")).alias("entries"), F.sum("n").alias("whole"), F.sum("docs").alias("docs"))
        .filter(F.col("docs") >= least_docs)
        .drop("docs")
    )
    cells = kept.select("lang", "term", "whole", F.explode("entries").alias("e")).select(
        "lang", "term", "whole", "e.source", "e.n"
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("whole").alias("lang_total"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"))
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    groups = stored(
        named.join(totals, ["lang", "source"], "left")
        .join(langs, "lang", "left")
        .fillna(0, ["total", "own", "terms", "lang_total"])
        .withColumn("place", place)
        .withColumn("b", F.expr(f"IF(terms = 0, 1, {_share('0', 'total', 'greatest(terms, 1)')})"))
    )
    shares = cells.join(groups.drop("own"), ["lang", "source"])
    shares = stored(shares.withColumn("p", F.expr(_share("n", "total", "terms"))))
    return _pairs(groups, shares).unionByName(_top_terms(groups, shares, ranks))


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """Part ``pair``."""
    entry = F.struct("place", "p", "b")
    extra = _shared_terms(shares.groupBy("lang", "term").agg(F.collect_list(entry).alias("entries")))
    both = F.explode(F.array(F.struct("one", "other"), F.struct(F.col("other").alias("one"), F.col("one").alias("other"))))
    extra = extra.select("lang", both.alias("pair"), "extra").select("lang", "pair.one", "pair.other", "extra")
    others = groups.select("lang", F.col("place").alias("other"), F.col("source").alias("item"),
                           F.col("b").alias("other_b"), F.col("own").alias("other_own"))
    histogram = shares.groupBy("lang", "place", "p").agg(F.count("*").alias("times"))
    alone = (
        histogram.join(others, "lang")
        .filter("place <> other")
        .groupBy("lang", "place", "other")
        .agg(F.expr(f"sum(CAST(times AS DECIMAL(19,0)) * {_gap('p', 'other_b')})").alias("alone"))
    )
    mirrored = alone.select("lang", F.col("other").alias("place"), F.col("place").alias("other"), F.col("alone").alias("mirrored"))
    extra = extra.withColumnRenamed("one", "place")
    pairs = groups.join(others, "lang").filter("place <> other")
    for part in (alone, mirrored, extra):
        pairs = pairs.join(part, ["lang", "place", "other"], "left")
    neither = f"CAST(terms - own - other_own AS DECIMAL(19,0)) * {_gap('b', 'other_b')}"
    value = f"coalesce(alone, 0) + coalesce(mirrored, 0) + coalesce(extra, 0) + {neither}"
    pairs = pairs.withColumn("value", F.expr(f"IF(terms = 0, 0L, CAST({value} AS LONG))"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def _top_terms(groups: DataFrame, shares: DataFrame, ranks: int) -> DataFrame:
    """Part ``term``."""
    q = F.expr(_share("whole", "lang_total", "terms"))
    local = skybands(shares.filter(F.col("p") > q), ranks)
    salted = local.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS))).repartition("lang", "source", "salt")
    merged = skybands(salted, ranks).join(groups, ["lang", "source"])
    ranked = merged.withColumn("p", F.expr(_share("n", "total", "terms"))).withColumn("q", q)
    ranked = ranked.withColumn("value", F.expr(_gap("p", "q")))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    top = ranked.withColumn("rank", rank).filter(F.col("rank") <= ranks)
    return top.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
