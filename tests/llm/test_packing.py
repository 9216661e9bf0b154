from __future__ import annotations

import random
import zlib
from bisect import insort

import numpy as np
import pyarrow as pa
import pytest

from stockflow.llm import packing
from tests.llm.rows import documents, prose


def plain_best_fit(lengths, window):
    """Remaining capacities after best-fit decreasing, one piece at a time."""
    left = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in left if r >= n), default=None)
        if fit is None:
            fit = window
        else:
            left.remove(fit)
        insort(left, fit - n)
    return sorted(left)


@pytest.mark.parametrize("seed", range(6))
def test_plan_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    window = rng.choice([16, 64, 100])
    lengths = [rng.choice([rng.randrange(1, window + 1), rng.randrange(1, 6)]) for _ in range(rng.choice([5, 200, 600]))]
    counts = {n: lengths.count(n) for n in lengths}
    rows = packing.plan(counts, window)
    fill = {}
    for length in counts:
        own = sorted(r[1:] for r in rows.tolist() if r[0] == length)
        for (rank, sequence, offset), after in zip(own, [*own[1:], [counts[length]]]):
            for k in range(after[0] - rank):
                fill.setdefault(sequence + k, []).append((offset, length))
    for pieces in fill.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window
    assert sum(map(len, fill.values())) == len(lengths)
    assert sorted(window - sum(n for _, n in p) for p in fill.values()) == plain_best_fit(lengths, window)


def test_ids_are_the_tokenizers(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50 * packing.ENTRY)
    own = packing.Encoder(__import__("public_tokenizers").path(packing.TOKENIZER))
    texts = [
        "", " ", "a  b", "a   b", " a", "a \n b", "a\n\n b", "x\t y  ", "a. b, it's 'we'll", "tail ", "tail\n", "1,2 3.4 a.b. c!!",
        "foo<|endoftext|> b", "é, ü! ß%%% x\xa0y \xa0 z", "a \x1c b\x1c\x1c c", "a\u3000 b  <|endoftext|>  c", "x" * 5000,
        "\u200b \u2028 \u0085 q", "emoji \U0001f600\U0001f600. done", *[prose(i, 300) for i in range(8)],
    ]
    for _ in range(2):
        for text in texts:
            want = own.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(own.ids(text), dtype="<u4").tolist() == want, text[:40]


def uneven(rng):
    """A text of words, marks and spaces of all kinds next to each other."""
    parts = [" ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", "\x85", "\u2003", "\u200b", "\x1c", "\x00", "\u180e", "\u3000"]
    parts += ["the", "word", "don't", "\u0142\xf3d\u017a", "stra\xdfe", "12", "a.b", "\xf7", "\u6f22\u5b57", "e\u0301", "\U0001f600", "<|endoftext|>"]
    parts += [".", "...", ",", "!?", "%%%", "$", "|", "'s", "\xb7", "-", " the", " of", " and", "\nSo", " word.", " word.\nSo"]
    return "".join(rng.choices(parts, k=rng.choice([1, 2, 3, 6, 40])))


@pytest.mark.parametrize("seed", range(3))
def test_ids_of_many_texts_are_the_tokenizers(seed, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 3000)
    monkeypatch.setattr(packing, "TOGETHER", 7)
    monkeypatch.setattr(packing, "REMEMBERED", 20 * packing.ENTRY)
    rng = random.Random(seed)
    texts = [rng.choice([None, "", prose(i, 60), *[uneven(rng) for _ in range(20)]]) for i in range(1500)]
    own = packing.Encoder(__import__("public_tokenizers").path(packing.TOKENIZER))
    batch = pa.record_batch({"doc_id": range(1503), "text": ["cut off", *texts, "a", "b"]}).slice(1, 1500)
    ends, seen = own.tokenizer.encode, []
    for part in packing._parts(batch):
        ids, at = own.documents(part["text"])
        for k, i in enumerate(part["doc_id"].to_pylist()):
            want = [*ends(texts[i - 1] or "", add_special_tokens=False).ids, packing.END_ID]
            assert ids[at[k] : at[k + 1]].tolist() == want, texts[i - 1]
            seen.append(i)
    assert seen == list(range(1, 1501))


def test_a_word_of_many_texts_is_encoded_once(monkeypatch):
    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer, self.characters = tokenizer, 0

        def encode_batch_fast(self, texts, **how):
            self.characters += sum(map(len, texts))
            return self.tokenizer.encode_batch_fast(texts, **how)

    monkeypatch.setattr(packing, "REMEMBERED", 0)
    own = packing.Encoder(__import__("public_tokenizers").path(packing.TOKENIZER))
    own.tokenizer = Counting(own.tokenizer)
    texts = [prose(i % 4, 400) + ".\n\n" * (i % 2) for i in range(40)]
    own.documents(pa.array(texts))
    words = {w.strip(".,!?") for text in texts for w in text.split()}
    assert own.tokenizer.characters <= 2 * sum(len(w) + 1 for w in words) + 50


def test_every_id_lies_in_one_piece(spark):
    rows = [(i, prose(i, n)) for i, n in enumerate([0, 3, 900, 4000, 12, 700, 650])] + [(7, None)]
    got = packing.pack(documents(spark, rows), rows_per_bin=1).collect()
    encode = packing.encoder(None).tokenizer.encode
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in rows:
        ids = np.array([*encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(ids))
            assert r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
