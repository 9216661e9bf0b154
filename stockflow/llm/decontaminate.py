"""Benchmark decontamination with a generalised suffix automaton of the test items."""

from __future__ import annotations

import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.store import annotate, kept_in_workers
from stockflow.llm.words import ALNUM, byte_rows, covered, lower, spans, word_hashes

WINDOW = 13
#: A document is contaminated if hits are at least one word in this many.
COVERAGE = 20
#: Text bytes of the items in one automaton; more items make more automata.
BLOCK_BYTES = 1 << 20
#: Automata a Python worker keeps at once.
KEPT = 4


class Automaton:
    """Suffix automaton of several word sequences, with the items whose windows it holds.

    A state stands for the sub-sequences with the same ends; ``link`` leads to the longest suffix
    with more ends. Streaming words through it tracks the longest suffix that occurs in an item.
    """

    def __init__(self, items: list[tuple[str, list[int]]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        for _, words in items:
            at = 0
            for w in words:
                at = self._extend(at, w)
        self.whole: dict[int, set[str]] = {}
        self.short: dict[int, list[tuple[int, str]]] = {}
        for name, words in items:
            if 0 < len(words) < window:
                self.short.setdefault(self._state(words), []).append((len(words), name))
            for end in range(window, len(words) + 1):
                self.whole.setdefault(self._state(words[end - window : end]), set()).add(name)
        self.marked = {s for s in range(len(self.link)) if self._above_short(s)} if self.short else set()

    def _state(self, words: list[int]) -> int:
        at = 0
        for w in words:
            at = self.next[at][w]
        return at

    def _above_short(self, state: int) -> bool:
        while state > 0:
            if state in self.short:
                return True
            state = self.link[state]
        return False

    def _add(self, length: int, moves: dict[int, int], link: int) -> int:
        self.length.append(length)
        self.next.append(moves)
        self.link.append(link)
        return len(self.link) - 1

    def _split(self, source: int, target: int, word: int) -> int:
        """The state of the sub-sequences of ``target`` that are no longer than those via ``source``."""
        if self.length[target] == self.length[source] + 1:
            return target
        copy = self._add(self.length[source] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while source >= 0 and self.next[source].get(word) == target:
            self.next[source][word] = copy
            source = self.link[source]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        new = self._add(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, self.next[at][word], word)
        return new

    def stream(self, words: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """(first word, words) of every window found, and the items that hold them."""
        found, items = [], set()
        at = matched = 0
        for i, w in enumerate(words):
            while at and w not in self.next[at]:
                at = self.link[at]
                matched = self.length[at]
            if w in self.next[at]:
                at = self.next[at][w]
                matched += 1
            if matched >= self.window:
                state = at
                while self.length[self.link[state]] >= self.window:
                    state = self.link[state]
                if state in self.whole:
                    found.append((i - self.window + 1, self.window))
                    items |= self.whole[state]
            if at in self.marked:
                state, most = at, matched
                while state > 0:
                    for n, name in self.short.get(state, ()):
                        if n <= most:
                            found.append((i - n + 1, n))
                            items.add(name)
                    state = self.link[state]
                    most = self.length[state]
        return found, items


class Block:
    """An automaton with a vocabulary, and filters that leave most words to NumPy.

    Only stretches of words that are in the vocabulary and whose neighbours follow each other in
    some item go through the automaton: every window lies inside such a stretch.
    """

    def __init__(self, items: list[tuple[str, str]], window: int):
        split = [(name, _words(text)) for name, text in items]
        split = [(name, words) for name, words in split if words]
        self.words = sorted({w for _, words in split for w in words})
        number = {w: i for i, w in enumerate(self.words)}
        coded = [(name, [number[w] for w in words]) for name, words in split]
        self.automaton = Automaton(coded, window)
        self.least = min((min(window, len(words)) for _, words in coded), default=0)
        hashes = np.array([_hash(w) for w in self.words], dtype=np.uint64)
        self.order = np.argsort(hashes).astype(np.int64)
        self.hashes = hashes[self.order]
        pairs = {a * len(self.words) + b for _, words in coded for a, b in zip(words, words[1:])}
        self.pairs = np.array(sorted(pairs), dtype=np.int64)

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.order[at], -1)

    def scan(self, text: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray):
        """(first word, words) of each window of an item in the text, and the items."""
        found, items = [], set()
        if not self.words or len(hashes) < self.least:
            return found, items
        numbers = self._numbers(hashes)
        known = numbers >= 0
        if self.least < 2:
            first, last = _runs(known)
        else:
            both = np.flatnonzero(known[:-1] & known[1:])
            codes = numbers[both] * len(self.words) + numbers[both + 1]
            at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
            follows = np.zeros(len(known) - 1, dtype=bool)
            follows[both] = self.pairs[at] == codes
            first, last = _runs(follows)
            last = last + 1
        long = last - first >= self.least
        for a, b in zip(first[long].tolist(), last[long].tolist()):
            run = numbers[a:b].tolist()
            run = [n if text[s:e].tobytes() == self.words[n] else -1 for n, s, e in zip(run, start[a:b], end[a:b])]
            hits, names = self.automaton.stream(run)
            found += [(a + i, n) for i, n in hits]
            items |= names
        return found, items


def _runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mark.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _words(text: str) -> list[bytes]:
    data = lower(np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8))
    return [data[s:e].tobytes() for s, e in zip(*spans(data, ALNUM))]


def _hash(word: bytes) -> int:
    data = np.frombuffer(word, dtype=np.uint8)
    return int(word_hashes(data, np.array([0]), np.array([len(data)]))[0])


_CACHE: OrderedDict = OrderedDict()
kept_in_workers(__name__, _CACHE.clear)


def _block(shared, window: int) -> Block:
    """The block of a broadcast list of items, built once per worker while it is in use."""
    key = (shared.uid, window)
    if key not in _CACHE:
        _CACHE[key] = Block(shared.value.items, window)
        while len(_CACHE) > KEPT:
            _CACHE.popitem(last=False)
    _CACHE.move_to_end(key)
    return _CACHE[key]


class _Items:
    def __init__(self, items: list[tuple[str, str]]):
        self.items = items


class _Shared:
    """A broadcast with a name that workers agree on."""

    def __init__(self, broadcast, uid: str):
        self.broadcast, self.uid = broadcast, uid

    @property
    def value(self):
        return self.broadcast.value


def _blocks(benchmark: DataFrame) -> list[_Shared]:
    """The items in blocks of about ``BLOCK_BYTES``, each broadcast on its own.

    The bytes are counted first, so the size of a broadcast is known before it is sent.
    """
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("name"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(size / BLOCK_BYTES))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("name", "text"), F.lit(count)))
    sc = benchmark.sparkSession.sparkContext
    out = []
    for i in range(count):
        rows = [(r["name"], r["text"]) for r in dealt.filter(F.col("block") == i).collect()]
        shared = sc.broadcast(_Items(sorted(rows, key=str)))
        out.append(_Shared(shared, f"{sc.applicationId}-{shared._jbroadcast.id()}"))
    return out


def scan(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """The columns ``keep`` as ``row``; n_words, n_hit, items and spans of each document.

    Words are lower-cased runs of letters, digits and characters beyond ASCII. A document word is
    hit inside any occurrence of ``window`` consecutive item words, or of a whole item of fewer.
    ``spans`` are the byte ranges of the text that hits fill. Null texts have no words; items
    without words match nothing; rows that repeat an item_id count as one item and a null item_id
    is the empty name; an empty benchmark hits nothing.
    """
    shared = _blocks(benchmark)

    def compute(texts: pa.Array) -> dict[str, object]:
        out = {"n_words": [], "n_hit": [], "items": [], "spans": []}
        hits: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        names: list[set[str]] = [set() for _ in range(len(texts))]
        # Blocks outside: a batch needs each automaton once, however many there are.
        for block in shared:
            automaton = _block(block, window)
            for i, raw in enumerate(byte_rows(texts)):
                text = lower(raw)
                start, end = spans(text, ALNUM)
                found, items = automaton.scan(text, start, end, word_hashes(text, start, end))
                hits[i] += found
                names[i] |= items
        for raw, found, items in zip(byte_rows(texts), hits, names):
            start, end = spans(lower(raw), ALNUM)
            hit = np.zeros(len(start), dtype=bool)
            for size in {n for _, n in found}:
                hit |= covered(len(start), np.array([i for i, n in found if n == size]), size)
            first, last = _runs(hit)
            out["n_words"].append(len(start))
            out["n_hit"].append(int(hit.sum()))
            out["items"].append(sorted(items))
            out["spans"].append([{"begin": int(start[a]), "stop": int(end[b - 1])} for a, b in zip(first, last)])
        return out

    fields = "n_words long, n_hit long, items array<string>, spans array<struct<begin: long, stop: long>>"
    return annotate(docs, keep, fields, compute).withColumn(
        "contaminated", F.expr(f"n_hit > 0 AND {COVERAGE} * n_hit >= n_words")
    )


def cut_spans(text: str, cuts: list[tuple[int, int]]) -> str:
    """``text`` without the byte ranges ``cuts``."""
    data, at, out = text.encode("utf-8", "surrogatepass"), 0, []
    for begin, stop in cuts:
        out.append(data[at:begin])
        at = stop
    return b"".join([*out, data[at:]]).decode("utf-8", "surrogatepass")


def clean_texts(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW) -> DataFrame:
    """Like ``scan`` with ``clean_text``: the text without its hit spans."""

    @F.pandas_udf("string")
    def cut(text, found):
        return type(text)(
            [None if t is None else cut_spans(t, [(s["begin"], s["stop"]) for s in f]) for t, f in zip(text, found)]
        )

    names = list(dict.fromkeys([*keep, "text"]))
    return scan(docs, benchmark, names, window).withColumn("clean_text", cut("row.text", "spans"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents below the coverage limit, all columns unchanged.

    A document with a hit, and hits on at least one word in ``COVERAGE``, goes as a whole; what
    would be left of it is mostly what frames a test item. Rows that repeat are judged alike.
    """
    return scan(docs, benchmark, docs.columns, window).filter("NOT contaminated").select("row.*")


def verdicts(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every document."""
    return scan(docs, benchmark, ["doc_id"], window).selectExpr(
        "row.doc_id AS doc_id",
        "n_words",
        "n_hit",
        "cast(size(items) AS long) AS n_items",
        "sha2(array_join(items, ','), 256) AS items_sha256",
        "contaminated",
    )
