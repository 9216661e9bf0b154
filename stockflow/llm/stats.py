"""Counts that rules and classifiers take from a text, each over the whole text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from stockflow.llm.words import SPACED, byte_rows, covered, spans, window_hashes, word_hashes

#: The characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_WHITE = b" \t\n\r\x0b\x0c"

FIELDS = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_lines": "long",
    "n_distinct": "long",
    "n_upper": "long",
    "n_marks": "long",
    "n_letters": "long",
}


def _table(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


_SYMBOL = _table(SYMBOLS)
_UPPER = _table(bytes(range(0x41, 0x5B)))
_MARK = _table(b"!?.,;:")
_LETTER = _table(bytes([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x100)]))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80


def text_counts(text: np.ndarray) -> dict[str, int]:
    """The counts of ``FIELDS`` for the bytes of one text."""
    start, end = spans(text, SPACED)
    hashes = word_hashes(text, start, end)
    n = len(hashes)
    per_byte = np.bincount(text, minlength=256)
    threes = window_hashes(hashes, 3)
    repeated = 0
    if len(threes):
        _, inverse, times = np.unique(threes, return_inverse=True, return_counts=True)
        twice = np.flatnonzero(times[inverse] >= 2)
        if len(twice):
            repeated = int(covered(n, twice, 3).sum())
    seen, lines, copies = set(), 0, 0
    for line in text.tobytes().split(b"\n"):
        if line.strip(_WHITE):
            lines += 1
            copies += line in seen
            seen.add(line)
    return {
        "n_words": n,
        "word_chars": int(per_byte[_FIRST_BYTE & SPACED].sum()),
        "n_symbols": int(per_byte[_SYMBOL].sum()),
        "n_dup_lines": copies,
        "n_repeat_words": repeated,
        "n_lines": lines,
        "n_distinct": len(np.unique(hashes)),
        "n_upper": int(per_byte[_UPPER].sum()),
        "n_marks": int(per_byte[_MARK].sum()),
        "n_letters": int(per_byte[_LETTER].sum()),
    }


def counts(texts: pa.Array) -> dict[str, list[int]]:
    """The counts of a batch of texts, a list per field."""
    rows = [text_counts(t) for t in byte_rows(texts)]
    return {name: [r[name] for r in rows] for name in FIELDS}


def ddl() -> str:
    return ", ".join(f"{name} {kind}" for name, kind in FIELDS.items())


#: Names of the ratios that ``ratios`` gives, in its order.
RATIOS = ["length", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "marks", "letters"]


def ratios(c: dict[str, np.ndarray]) -> np.ndarray:
    """Scale-free statistics (rows by ``RATIOS``) of count columns; texts without words give zeros."""
    words = np.maximum(c["n_words"], 1).astype(float)
    chars = np.maximum(c["word_chars"], 1).astype(float)
    root = np.sqrt(words)
    return np.stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / np.maximum(c["n_lines"], 1),
            c["n_repeat_words"] / words,
            c["n_distinct"] / root / np.log1p(words),
            c["n_upper"] / chars,
            c["n_marks"] / words,
            c["n_letters"] / chars,
        ],
        axis=1,
    ).astype(float)
