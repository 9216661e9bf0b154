"""Substring dedup: recurring passages found by Aho-Corasick automata, their later copies removed."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.store import annotate, map_arrow, stored
from stockflow.llm.words import SPACED, byte_rows, covered, spans, window_hashes, word_hashes

WINDOW = 20
#: Words of the phrase that stands for the windows around it.
PHRASE = 6
#: Bytes of distinct segments that one automaton should decide on. The windows of an anchor with more
#: are dealt by their own hash.
SHARD_BYTES = 1 << 20
#: What tells one text from another: 128 bits of hashes.
_TEXT_KEY = ["key", "check"]


def anchors(hashes: np.ndarray, window: int = WINDOW, phrase: int = PHRASE) -> tuple[np.ndarray, np.ndarray]:
    """For each window the place of its anchor phrase, and the hash of every phrase.

    The anchor is the leftmost phrase of least hash, so equal windows have equal anchors at equal
    places, and neighbouring windows mostly share one.
    """
    grams = window_hashes(hashes, phrase)
    width = window - phrase + 1
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64), grams
    place = np.empty(n, dtype=np.int64)
    for i in range(0, n, 1 << 16):
        j = min(n, i + (1 << 16))
        view = np.lib.stride_tricks.sliding_window_view(grams[i : j + width - 1], width)
        place[i:j] = view.argmin(axis=1) + np.arange(i, j)
    return place, grams


def _signed(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype(np.uint64).view(np.int64)


def _phrases(texts: DataFrame, window: int, phrase: int) -> DataFrame:
    """(anchor, key, times): the distinct anchor phrases of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch["key"].to_numpy(zero_copy_only=False)
            size, found, times = [], [], []
            for text in byte_rows(batch["text"]):
                place, grams = anchors(word_hashes(text, *spans(text, SPACED)), window, phrase)
                hashes, n = np.unique(grams[np.unique(place)], return_counts=True)
                size.append(len(hashes))
                found.append(hashes)
                times.append(n)
            if size:
                columns = [_signed(np.concatenate(found)), np.repeat(keys, size), np.concatenate(times).astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "key", "times"])

    return map_arrow(texts.select("key", "text"), run, "anchor long, key long, times int")


def _segments(texts: DataFrame, window: int, phrase: int) -> DataFrame:
    """(anchor, segment, doc, key, check, start): the words of the windows that share a candidate anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, anchor, segment, begin = [], [], [], []
            candidates = batch["anchors"].to_pylist()
            for i, text in enumerate(byte_rows(batch["text"])):
                start, end = spans(text, SPACED)
                place, grams = anchors(word_hashes(text, start, end), window, phrase)
                wanted = np.isin(_signed(grams), np.array(candidates[i], dtype=np.int64))
                if not len(place):
                    continue
                words = text.tobytes().split()
                first = np.flatnonzero(np.diff(place, prepend=-1))
                last = np.append(first[1:], len(place))
                for a, b in zip(first.tolist(), last.tolist()):
                    if wanted[place[a]]:
                        rows.append(i)
                        anchor.append(int(_signed(grams[place[a] : place[a] + 1])[0]))
                        segment.append(b" ".join(words[a : b + window - 1]).decode("utf-8", "replace"))
                        begin.append(a)
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchor, pa.int64()),
                    pa.array(segment, pa.string()),
                    batch["doc"].take(at),
                    batch["key"].take(at),
                    batch["check"].take(at),
                    pa.array(begin, pa.int64()),
                ],
                ["anchor", "segment", "doc", "key", "check", "start"],
            )

    return map_arrow(texts, run, "anchor long, segment string, doc long, key long, check long, start long")


def locate(patterns: Iterable[tuple[int, ...]], texts: list[tuple[int, ...]]) -> list[list[tuple[int, int]]]:
    """For each text the (first word, words) of every pattern in it, by one automaton.

    Texts and patterns are sequences of word numbers.
    """
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for words in patterns:
        automaton.add_word(words, len(words))
    if not len(automaton):
        return [[] for _ in texts]
    automaton.make_automaton()
    return [[(end - n + 1, n) for end, n in automaton.iter(words)] for words in texts]


def _same_windows(words: np.ndarray, window: int) -> np.ndarray:
    """A number for the window that starts at each place; equal windows alone share one.

    Numbers of twice as long windows come from pairs of numbers, without hashing.
    """

    def pairs(one: np.ndarray, other: np.ndarray) -> np.ndarray:
        both = one[: len(other)] * (int(other.max(initial=0)) + 1) + other
        return np.unique(both, return_inverse=True)[1].ravel()

    power, size = words, 1
    out, have = None, 0
    while True:
        if window & size:
            out = power if out is None else pairs(out, power[have:])
            have += size
        if have == window or len(power) <= size:
            return out if have == window else words[:0]
        power, size = pairs(power, power[size:]), 2 * size


def _passages(places: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of consecutive places of one owner."""
    new = (np.diff(places, prepend=-2) != 1) | (np.diff(owner, prepend=-1) != 0)
    first = np.flatnonzero(new)
    last = np.append(first, len(places))[1:] - 1
    return places[first], places[last]


def _decide(rows: pa.Table, window: int) -> pa.RecordBatch:
    """(anchor, segment_hash, firsts) of the segments of one shard that hold recurring windows.

    Windows that recur are confirmed by number; runs of them are passages, whose automaton then
    reads the segments for the places of each.
    """
    numbers: dict[str, int] = {}
    split = [text.split(" ") for text in rows["segment"].to_pylist()]
    coded = [tuple([numbers.setdefault(w, len(numbers)) for w in words]) for words in split]
    size = np.array([len(words) for words in coded], dtype=np.int64)
    begin = np.cumsum(size) - size
    words = np.fromiter((w for text in coded for w in text), dtype=np.int64, count=int(size.sum()))
    owner = np.repeat(np.arange(len(coded)), size)
    at = np.arange(len(words)) - begin[owner]
    place = np.flatnonzero(at + window <= size[owner])
    same = _same_windows(words, window)[place] if len(place) else place
    # In 64 bits: a shard holds its segments, which stand for few places beyond that.
    total = np.zeros(int(same.max(initial=-1)) + 1, dtype=np.int64)
    np.add.at(total, same, rows["places"].to_numpy()[owner[place]])
    recurs = total[same] > 1
    place, same = place[recurs], same[recurs]

    first = rows["first"].combine_chunks()
    late, doc, key, check, start = (
        pc.fill_null(first.field(name).cast(pa.int64()), 0).to_numpy() for name in ("late", "doc", "key", "check", "start")
    )
    mine = owner[place]
    order = np.lexsort((start[mine] + at[place], check[mine], key[mine], doc[mine], late[mine], same))
    leads = order[np.flatnonzero(np.diff(same[order], prepend=-1))]
    lead = np.empty(len(total), dtype=np.int64)
    lead[same[leads]] = place[leads]

    patterns = {tuple(words[a : b + window].tolist()): None for a, b in zip(*_passages(place, mine))}
    marked = np.zeros(len(words) + 1, dtype=np.int64)
    for n, hits in enumerate(locate(patterns, coded)):
        for a, pattern in hits:
            marked[begin[n] + a] += 1
            marked[begin[n] + a + pattern - window + 1] -= 1
    found = np.flatnonzero(np.cumsum(marked) > 0)
    number = np.full(len(words), -1, dtype=np.int64)
    number[place] = same
    source = lead[number[found]]
    there = owner[source]
    entry = [at[found], key[there], check[there], start[there] + at[source]]
    holders, sizes = np.unique(owner[found], return_counts=True)
    listed = pa.StructArray.from_arrays([pa.array(c) for c in entry], ["at", "key", "check", "start"])
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    kept = [rows[c].take(pa.array(holders)).combine_chunks() for c in ("anchor", "segment_hash")]
    return pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(offsets, listed)], ["anchor", "segment_hash", "firsts"])


_FIRSTS = "array<struct<at: long, key: long, check: long, start: long>>"


def _first_starts(distinct: DataFrame, shards: int, window: int) -> DataFrame:
    """(anchor, segment_hash, firsts): for each recurring window of a segment where it first starts.

    ``distinct`` has each (anchor, segment) once, with its first place and its number of places.
    Equal windows share their anchor, so a shard of anchors decides on its own. The shards of a
    partition come one after the other, each with an automaton of its own.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, []
        for batch in batches:
            shards = batch["shard"].to_numpy()
            edges = np.flatnonzero(np.diff(shards)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(shards)]):
                if b > a and shards[a] != shard:
                    if held:
                        yield _decide(pa.Table.from_batches(held), window)
                    shard, held = shards[a], []
                held.append(batch.slice(a, b - a))
        if held:
            yield _decide(pa.Table.from_batches(held), window)

    dealt = distinct.withColumn("shard", F.pmod("anchor", F.lit(shards))).repartition("shard")
    return map_arrow(dealt.sortWithinPartitions("shard"), run, f"anchor long, segment_hash long, firsts {_FIRSTS}")


def _hot_anchors(distinct: DataFrame) -> DataFrame:
    """(anchor): those whose distinct segments have over ``SHARD_BYTES``; few, as each has so many."""
    sizes = distinct.groupBy("anchor").agg(F.sum(F.octet_length("segment")).alias("size"))
    return sizes.filter(F.col("size") > SHARD_BYTES).select("anchor")


def _window_firsts(distinct: DataFrame, window: int) -> DataFrame:
    """What ``_first_starts`` gives, by aggregation of windows: no task holds an anchor's segments.

    Windows of an anchor are told apart by 128 bits of hashes.
    """
    texts = f"transform(sequence(0, size(words) - {window}), j -> array_join(slice(words, j + 1, {window}), ' '))"
    words = distinct.select("anchor", "segment_hash", "first", "places", F.split("segment", " ", -1).alias("words"))
    each = words.select("anchor", "segment_hash", "first", "places", F.posexplode(F.expr(texts)).alias("at", "text"))
    each = each.withColumn("at", F.col("at").cast("long"))
    each = each.withColumn("hash", F.xxhash64("text")).withColumn("other", F.xxhash64(F.lit(1), "text"))
    same = ["anchor", "hash", "other"]
    start = (F.col("first.start") + F.col("at")).alias("start")
    least = F.min(F.struct("first.late", "first.doc", "first.key", "first.check", start)).alias("least")
    recurring = each.groupBy(*same).agg(least, F.sum("places").alias("all")).filter(F.col("all") > 1)
    found = each.select("segment_hash", "at", *same).join(recurring, same)
    entry = F.struct("at", "least.key", "least.check", "least.start")
    return found.groupBy("anchor", "segment_hash").agg(F.collect_list(entry).alias("firsts"))


def _keyed(docs: DataFrame, *more) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    keys = F.xxhash64(text).alias("key"), F.xxhash64(F.lit(1), text).alias("check")
    return docs.select(F.col("doc_id").cast("long").alias("doc"), text.alias("text"), *keys, *more)


def repeated_starts(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """(key, check, owner, starts) of every text that recurs in whole or in part.

    ``owner`` is the least doc_id with the text, ``starts`` the first words of its windows that
    also start earlier elsewhere.

    Equal texts collapse to their key first. A text's windows are represented by anchor phrases;
    only phrases that recur are candidates, so texts are cut into segments just there. Equal
    segments collapse before the shuffle, whatever the number of documents that share a passage;
    automata then decide for each distinct segment, of anchors with many an aggregation of their
    windows, and a join, whose hot keys Spark splits,
    brings the result to all places.
    """
    texts = _keyed(docs)
    owners = stored(texts.groupBy(*_TEXT_KEY).agg(F.min("doc").alias("owner"), F.count("*").alias("copies")))
    phrases = stored(_phrases(texts, window, phrase))
    shared = (
        phrases.groupBy("anchor")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"), F.max("times").alias("times"))
        .filter("least <> most OR times > 1")
        .select("anchor")
    )
    wanted = stored(
        phrases.join(shared, "anchor").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    )
    owned = wanted.join(owners, "key").select(*_TEXT_KEY, "owner", "anchors")
    same = [texts[c] == owned[c] for c in _TEXT_KEY]
    cut = texts.join(owned, [*same, texts.doc.eqNullSafe(owned.owner)]).select(
        "doc", "text", *[texts[c] for c in _TEXT_KEY], "anchors"
    )
    segments = stored(_segments(cut, window, phrase).withColumn("segment_hash", F.xxhash64("segment")))
    place = [*_TEXT_KEY, "start"]
    distinct = segments.groupBy("anchor", "segment_hash", "segment").agg(
        F.min(F.struct(F.col("doc").isNull().alias("late"), "doc", *place)).alias("first"),
        F.count("*").alias("places"),
    )
    distinct = stored(distinct)
    hot = stored(_hot_anchors(distinct))
    cool = distinct.join(hot, "anchor", "left_anti")
    size = cool.agg(F.sum(F.octet_length("segment"))).first()[0] or 0
    decided = _first_starts(cool, max(1, math.ceil(size / SHARD_BYTES)), window)
    firsts = stored(decided.unionByName(_window_firsts(distinct.join(hot, "anchor"), window)))
    elsewhere = "f -> f.key <> key OR f.check <> check OR f.start <> start + f.at"
    marks = (
        segments.join(firsts, ["anchor", "segment_hash"])
        .select(*_TEXT_KEY, F.expr(f"transform(filter(firsts, {elsewhere}), f -> start + f.at)").alias("starts"))
        .filter("size(starts) > 0")
        .groupBy(*_TEXT_KEY)
        .agg(F.flatten(F.collect_list("starts")).alias("starts"))
    )
    known = owners.join(marks, _TEXT_KEY, "left").filter("copies > 1 OR starts IS NOT NULL")
    return stored(known.select(*_TEXT_KEY, "owner", "starts"))


def _removed(n: int, is_owner: bool, starts: list[int] | None, window: int) -> np.ndarray:
    """Which words go: all that a window covers in a later copy, else those of the owner's marks."""
    if not is_owner:
        return np.full(n, n >= window)
    return covered(n, np.array(starts or [], dtype=np.int64), window)


def _marked(docs: DataFrame, window: int, phrase: int, keep: list[str]) -> DataFrame:
    """The columns ``keep`` as ``row``, the text, and what ``repeated_starts`` says of it."""
    marks = repeated_starts(docs, window, phrase)
    rows = _keyed(docs, F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"))
    is_owner = F.expr("owner <=> doc OR marked IS NULL").alias("is_owner")
    return rows.join(marks.withColumn("marked", F.lit(1)), _TEXT_KEY, "left").select("row", "text", is_owner, "starts")


def removals(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document.

    Each word goes that lies in a window of ``window`` words whose sequence also starts earlier:
    in a smaller doc_id, or earlier in the same document. Null texts have no words; a null doc_id
    comes after all others; rows that repeat an id and a text are one document, and different
    texts under one id follow in the order of their hashes; ids are whole numbers, and others raise
    an error; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, digests = [], [], []
            owner, starts = batch["is_owner"].to_pylist(), batch["starts"].to_pylist()
            for text, own, found in zip(byte_rows(batch["text"]), owner, starts):
                words = text.tobytes().split()
                removed = _removed(len(words), own, found, window)
                kept = [w for w, r in zip(words, removed.tolist()) if not r] if removed.any() else words
                total.append(len(words))
                gone.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            columns = [batch["row"].field("doc_id"), pa.array(total), pa.array(gone), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    marked = _marked(docs, window, phrase, ["doc_id"])
    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(marked, run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def cut_words(text: np.ndarray, removed: np.ndarray) -> bytes:
    """The text without the removed words and the white space after each."""
    start, _ = spans(text, SPACED)
    stop = np.append(start[1:], len(text))
    keep = np.ones(len(text), dtype=bool)
    edge = np.zeros(len(text) + 1, dtype=np.int64)
    np.add.at(edge, start[removed], 1)
    np.add.at(edge, stop[removed], -1)
    keep &= np.cumsum(edge[:-1]) == 0
    return text[keep].tobytes()


def without_repeats(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE) -> DataFrame:
    """The rows of ``docs`` with ``text`` cut by what ``removals`` removes, ``n_chars`` adjusted.

    Rows from which nothing goes are returned unchanged; one that loses all its words stays, with
    an empty text.
    """
    marked = _marked(docs, window, phrase, docs.columns)

    def compute(texts: pa.Array) -> dict[str, object]:
        packed = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
        out = []
        rows = zip(byte_rows(packed.field("text")), packed.field("own").to_pylist(), packed.field("starts").to_pylist())
        for text, own, found in rows:
            start, _ = spans(text, SPACED)
            removed = _removed(len(start), own, found, window)
            out.append(cut_words(text, removed).decode("utf-8", "replace") if removed.any() else None)
        return {"cut": out}

    packed = marked.select("row", F.struct("text", F.col("is_owner").alias("own"), "starts").alias("text"))
    cut = annotate(packed, ["row"], "cut string", compute)
    columns = []
    for name in docs.columns:
        old = F.col(f"row.row.`{name}`")
        if name == "text":
            old = F.coalesce("cut", old)
        if name == "n_chars":
            old = F.when(F.col("cut").isNotNull(), F.length("cut").cast(dict(docs.dtypes)[name])).otherwise(old)
        columns.append(old.alias(name))
    return cut.select(*columns)
