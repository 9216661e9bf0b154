"""Packing of token sequences by best-fit decreasing over counts of lengths."""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.store import kept_in_workers, map_arrow, stored

WINDOW = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
#: Bytes of words and their ids that a Python worker remembers, and what an entry takes besides; of
#: longer words than ``SHORT`` characters nothing is remembered.
REMEMBERED = 96 << 20
ENTRY = 190
SHORT = 64
#: Bytes of texts that are cut into words at once, and words that are encoded in one text.
SLICE = 2 << 20
TOGETHER = 200
_SPACES = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_UNEVEN = f"\\A\\z|\\A[{_SPACES}]|[{_SPACES}][{_SPACES}]|[{_SPACES}]\\z"
_RUNS = re.compile(f"(\\A[{_SPACES}]+|[{_SPACES}]{{2,}}|[{_SPACES}]+\\Z)")
_TAIL = "([A-Za-z\xe0-\xf6\xf8-\xff])[.,!?;:%#$&*|]+\\z"


def _stretches(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``data`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(lengths)
    at = np.repeat((starts - (ends - lengths)).astype(np.int32), lengths)
    at += np.arange(len(at), dtype=np.int32)
    return data[at]


def _begins(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)])


def _texts(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of strings, and where each begins and the last ends."""
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, dtype=np.int32)[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8), at.astype(np.int64)


class Encoder:
    """Ids of texts, as little-endian 32-bit numbers, by a byte-level BPE of the tokenizers library.

    Such a tokenizer never joins a non-space character with a space or line break after it, a line
    break with what comes after it, nor a letter with the marks of ``_TAIL`` after it. Of several
    spaces the last alone can go with the word after it. So a text falls into words with a space or
    a line break before them that are encoded on their own, and many texts have each of them encoded
    once. Those found twice are remembered; when the memory is full the latest half, which are the
    rarest, goes.

    A word is written without the space before it, or with its line break; after a space comes what
    is encoded as it stands. The first word of a text has a line break that is no part of the text.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.held = 0
        leads = tuple(self.tokenizer.encode(c, add_special_tokens=False).tokens[0] for c in " \n")
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.opens[[i for token, i in vocabulary.items() if token.startswith(leads)]] = True
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4") for e in found]

    def _uneven_words(self, text: str) -> list[str]:
        """Words of a text that is empty or has spaces at an end or next to each other."""
        if any(token in text for token in self.added):
            return [" \n", f" {text}"]
        first, *rest = _RUNS.split(text)
        words = f"\n{first}".replace("\n", " \n").split(" ")[1:] if first else [" \n"]
        for run, stretch in zip(rest[::2], rest[1::2]):
            if not stretch:
                words.append(f" {run}")
                continue
            if run[:-1]:
                words.append(f" {run[:-1]}")
            own = stretch.replace("\n", " \n").split(" ")
            if run[-1] != " ":
                own[0] = f"\n{own[0]}" if run[-1] == "\n" else f" {run[-1]}{own[0]}"
            words += own
        return words

    def _words(self, texts: pa.Array) -> pa.Array:
        """A list of the words of each text."""
        uneven = pc.match_substring_regex(texts, _UNEVEN)
        even = texts.filter(pc.invert(uneven))
        lined = pc.binary_join_element_wise("\n", pc.replace_substring(even, "\n", " \n"), "")
        words = pc.split_pattern(lined, " ")
        if len(even) == len(texts):
            return words
        others = [self._uneven_words(t) for t in texts.filter(uneven).to_pylist()]
        order = np.argsort(uneven.to_numpy(zero_copy_only=False), kind="stable")
        return pa.concat_arrays([words, pa.array(others, words.type)]).take(pa.array(np.argsort(order)))

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word: of many in one text, cut where an id opens with a space or line break."""
        plain = [w for w in words if not w.startswith(" ")]
        found: dict[str, bytes] = {}
        for i in range(0, len(plain), TOGETHER):
            group = plain[i : i + TOGETHER]
            ids = self._encode(["".join([w if w.startswith("\n") else f" {w}" for w in group])])[0]
            first = np.flatnonzero(self.opens[ids])
            if len(first) == len(group):
                data, at = ids.tobytes(), [*(4 * first).tolist(), 4 * len(ids)]
                found.update(zip(group, [data[a:b] for a, b in zip(at, at[1:])]))
        rest = [w for w in words if w not in found]
        alone = [w if w.startswith("\n") else w[1:] if w.startswith(" ") else f" {w}" for w in rest]
        found.update(zip(rest, [ids.tobytes() for ids in self._encode(alone)]))
        return [found[w] for w in words]

    def _remember(self, words: list[str], ids: list[bytes]) -> None:
        for word, own in zip(words, ids):
            if len(word) <= SHORT:
                self.known[word] = own
                self.held += len(word) + len(own) + ENTRY
                if self.held > REMEMBERED:
                    for last in list(self.known)[len(self.known) // 2 :]:
                        self.held -= len(last) + len(self.known.pop(last)) + ENTRY

    def _spell(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each has.

        What words are without the marks at their end is encoded once, and the marks are.
        """
        stems = pc.replace_substring_regex(words, _TAIL, "\\1")
        data, at = _texts(words)
        marks = at[1:] - at[:-1] - np.diff(_texts(stems)[1])
        tail_bytes = _stretches(data, at[1:] - marks, marks)
        offsets = pa.py_buffer(_begins(marks).astype(np.int32))
        tails = pa.StringArray.from_buffers(len(words), offsets, pa.py_buffer(tail_bytes)).dictionary_encode()
        stems = stems.dictionary_encode()
        own, tail = stems.indices.to_numpy(), tails.indices.to_numpy()

        names = stems.dictionary.to_pylist()
        ids = [self.known.get(w) for w in names]
        missing = [i for i, found in enumerate(ids) if found is None]
        often = np.bincount(own, weights=counts, minlength=len(names)) > 1
        for i, found in zip(missing, self._encode_words([names[i] for i in missing])):
            ids[i] = found
        again = [i for i in missing if often[i]]
        self._remember([names[i] for i in again], [ids[i] for i in again])

        ids += [found.tobytes() for found in self._encode(tails.dictionary.to_pylist())]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begins = _begins(lengths)
        pairs = np.stack([own, tail + len(names)], axis=1).ravel()
        spelled = _stretches(np.frombuffer(b"".join(ids), dtype="<u4"), begins[pairs], lengths[pairs])
        return spelled, lengths[own] + lengths[tail + len(names)]

    def documents(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts with ``END_ID`` after each, in one array, and where each begins."""
        words = self._words(texts)
        coded = words.flatten().dictionary_encode()
        codes = coded.indices.to_numpy()
        first = _begins(pc.list_value_length(words).to_numpy())
        del words
        ids, lengths = self._spell(coded.dictionary, np.bincount(codes, minlength=len(coded.dictionary)))
        del coded
        begins, lengths = _begins(lengths)[codes], lengths[codes]
        at = _begins(lengths)[first]
        ids = _stretches(ids, begins, lengths)
        # The id of the line break before a text gives way to the end id of the text before.
        ids[at[:-1]] = END_ID
        return np.append(ids[1:], np.array([END_ID], dtype="<u4")), at

    def ids(self, text: str) -> bytes:
        return self.documents(pa.array([text]))[0][:-1].tobytes()


_ENCODERS: dict[str, Encoder] = {}
kept_in_workers(__name__, _ENCODERS.clear)


def encoder(path: str | None) -> Encoder:
    """The worker's encoder of a tokenizer file; None is the installed public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch whose texts, null ones empty, have ``SLICE`` bytes or little more."""
    sizes = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy().astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // SLICE)) + 1).tolist(), len(batch)]
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            part = batch.slice(a, b - a)
            texts = pc.fill_null(part["text"].cast(pa.string()), "")
            yield pa.RecordBatch.from_arrays([part["doc_id"], texts], ["doc_id", "text"])


def pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, length, ids_crc32 and doc_tokens of each piece of at most ``window`` ids.

    A document is its text's ids and the end id; every full window is a piece, the rest another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).documents
        for batch in batches:
            for part in _parts(batch):
                ids, at = encode(part["text"])
                tokens = np.diff(at)
                rows = np.repeat(np.arange(len(tokens)), -(-tokens // window))
                start = window * (np.arange(len(rows)) - np.searchsorted(rows, rows))
                length = np.minimum(window, tokens[rows] - start)
                begins = at[rows] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(begins.tolist(), (begins + length).tolist())]
                numbers = [pa.array(c, pa.int64()) for c in (start, length, crc, tokens[rows])]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(rows)), *numbers],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, start long, length long, ids_crc32 long, doc_tokens long"
    return map_arrow(docs.select("doc_id", "text"), run, schema)


class _Tree:
    """Segment tree over remaining capacities: the least one at or above a length that is open."""

    def __init__(self, size: int):
        self.leaves = 1 << max(1, (size + 1).bit_length())
        self.open = [False] * (2 * self.leaves)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.leaves
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def least(self, length: int) -> int | None:
        at = length + self.leaves
        if not self.open[at]:
            while at > 1 and not (at % 2 == 0 and self.open[at + 1]):
                at //= 2
            if at <= 1:
                return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.open[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(counts: dict[int, int], window: int = WINDOW) -> np.ndarray:
    """Best-fit decreasing for ``counts`` pieces per length, as rows (length, rank, sequence, offset).

    A row says: pieces of that length from that rank on, up to the next row's rank, go to
    consecutive sequences from ``sequence`` on, at ``offset``. Pieces of one length are
    interchangeable, so they are placed in bulk: the tightest open windows take as many each as
    fit before the next tightest, just as one by one. The work depends on the window, not on the
    number of pieces.
    """
    tree = _Tree(window)
    stock: dict[int, list[tuple[int, int]]] = {}
    rows: list[tuple[int, int, int, int]] = []
    sequences = 0

    def put(capacity: int, first: int, n: int) -> None:
        if n and capacity:
            stock.setdefault(capacity, []).append((first, n))
            tree.set(capacity, True)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            capacity = tree.least(length) if length < window else None
            if capacity is None:
                capacity, first = window, sequences
                n = -(-left // (window // length))
                sequences += n
            else:
                first, n = stock[capacity].pop()
                if not stock[capacity]:
                    tree.set(capacity, False)
            each = capacity // length
            full = min(n, left // each)
            if full:
                for layer in range(each):
                    rows.append((length, rank, first, window - capacity + layer * length))
                    rank += full
                left -= full * each
                put(capacity - each * length, first, full)
                first, n = first + full, n - full
            if n and left:
                few = min(left, each)
                for layer in range(few):
                    rows.append((length, rank, first, window - capacity + layer * length))
                    rank += 1
                left -= few
                put(capacity - few * length, first, 1)
                first, n = first + 1, n - 1
            put(capacity, first, n)
    return np.array(rows, dtype=np.int64).reshape(-1, 4)


def pack(
    docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, rows_per_bin: int = 1_000_000
) -> DataFrame:
    """Every piece with its sequence_id and offset; sequences are padded to ``window``.

    Null texts are empty and hold the end id alone; null and repeated ids are rows like others; an
    empty table gives no rows; other columns are ignored.

    Best fit needs only how many pieces each length has: at most ``window`` counts reach the
    driver, and the plan made of them has a size bound by the window alone. Each piece's rank
    among its length comes from counts per (length, bin) and a rank in the bin, so that a hot
    length is spread over tasks.
    """
    cut = stored(pieces(docs, window, tokenizer))
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = plan(counts, window)
    begins = rows[:, 0] << 48 | rows[:, 1]
    order = np.argsort(begins)
    begins, ranks, sequences, offsets = begins[order], rows[order, 1], rows[order, 2], rows[order, 3]
    shared = cut.sparkSession.sparkContext.broadcast((begins, ranks, sequences, offsets))

    bits = max(4, math.ceil(math.log2(max(1, sum(counts.values()) / rows_per_bin))))
    binned = cut.withColumn("bin", F.shiftrightunsigned(F.xxhash64("doc_id", "start", "ids_crc32"), 64 - bits))
    starts = (
        binned.groupBy("length", "bin")
        .agg(F.count("*").alias("n"))
        .selectExpr(
            "length",
            "bin",
            "coalesce(sum(n) OVER (PARTITION BY length ORDER BY bin "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begins",
        )
    )
    ranked = binned.join(starts, ["length", "bin"]).selectExpr(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        "begins + row_number() OVER (PARTITION BY length, bin ORDER BY doc_id, start, ids_crc32) - 1 AS rank",
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begins, ranks, sequences, offsets = shared.value
        for batch in batches:
            length, rank = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(begins, length << 48 | rank, side="right") - 1
            placed = [pa.array(sequences[at] + rank - ranks[at]), pa.array(offsets[at])]
            kept = [batch[c] for c in batch.schema.names if c != "rank"]
            names = [c for c in batch.schema.names if c != "rank"]
            yield pa.RecordBatch.from_arrays([*kept, *placed], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {t}" for c, t in ranked.dtypes if c != "rank")
    return map_arrow(ranked, place, f"{schema}, sequence_id long, offset long")
