"""Small tables for the corpus operators."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "river field bridge ferry man rope bow noon water road hill stone wind night lamp door".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "s", "ing", str(rng.randrange(99))]) for _ in range(n))


def documents(spark, rows, extra=""):
    """Rows of (doc_id, text) with the other columns of documents; ``extra`` adds a column."""
    full = [(i, t, "en", "s", None if t is None else len(t), *(["x"] if extra else [])) for i, t in rows]
    return spark.createDataFrame(full, DOCS + (f", {extra} string" if extra else ""))


#: Texts that break things: null, empty, blank, one word, odd bytes, repeats, very long.
ODD = [
    (0, None), (1, ""), (2, " \n\t "), (3, "word"), (4, "\x00 \x1c é\u2028ß \U0001f600"), (5, prose(1, 60)),
    (5, prose(1, 60)), (None, prose(1, 60)), (None, "word"), (None, None), (6, "a " * 3000), (7, prose(2, 40_000)),
    (8, "<|endoftext|> x"), (9, "line\n" * 50),
]
