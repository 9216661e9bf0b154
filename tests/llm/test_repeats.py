from __future__ import annotations

import hashlib
import random
import re

import numpy as np

from stockflow.llm import repeats
from tests.llm.rows import documents, prose

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(rows):
    """doc_id -> (words, removed, sha256 of what stays), window by window."""
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            window = tuple(words[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()
    return out


def cases():
    rng = random.Random(4)
    passages = [prose(100 + i, n) for i, n in enumerate((20, 21, 55, 19, 200))]
    rows = [(i, None if i == 3 else prose(i, rng.randrange(0, 120))) for i in range(12)]
    for i in range(12, 60):
        part = rng.choice(passages).split()
        a = rng.randrange(0, max(1, len(part) - 20))
        rows.append((i, " \n".join([prose(i, rng.randrange(0, 60)), " ".join(part[a:]), prose(i + 500, rng.randrange(9))])))
    rows += [(60, "a " * 90), (61, "a b " * 60), (62, " ".join([passages[2]] * 4)), (63, passages[2]), (64, "é " * 25)]
    rows += [(65 + i, rows[20][1]) for i in range(5)]
    return rows


def test_against_brute_force(spark):
    rows = cases()
    random.Random(1).shuffle(rows)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.removals(documents(spark, rows)).collect()}
    assert got == plain(rows)


def test_cut_texts_keep_what_removals_keep(spark):
    rows = cases()
    want = plain(rows)
    texts = dict(rows)
    for r in repeats.without_repeats(documents(spark, rows)).collect():
        n, gone, digest = want[r["doc_id"]]
        assert hashlib.sha256(" ".join(WORD.findall(r["text"] or "")).encode()).hexdigest() == digest
        if not gone:
            assert r["text"] == texts[r["doc_id"]]
        else:
            assert r["n_chars"] == len(r["text"])


def test_many_small_shards_decide_alike(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 500)
    rows = cases()
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.removals(documents(spark, rows)).collect()}
    assert got == plain(rows)


def test_no_shard_holds_the_segments_of_a_hot_anchor(spark, monkeypatch):
    """One passage in many surroundings: each gives distinct segments under the same anchors."""
    monkeypatch.setattr(repeats, "SHARD_BYTES", 4000)
    passage = prose(900, 25)
    rows = [(i, f"{prose(1000 + i, 30)} {passage} {prose(5000 + i, 30)}") for i in range(150)]
    most, first_starts = [], repeats._first_starts

    def watched(distinct, shards, window):
        most.append(distinct.groupBy("anchor").agg({"segment": "count"}).agg({"count(segment)": "max"}).first()[0])
        return first_starts(distinct, shards, window)

    monkeypatch.setattr(repeats, "_first_starts", watched)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in repeats.removals(documents(spark, rows)).collect()}
    assert got == plain(rows)
    assert sum(v[1] for v in got.values()) >= 149 * 25
    assert (most[0] or 0) < 75


def test_locate_finds_overlapping_patterns():
    assert sorted(repeats.locate([(1, 2), (2, 1), (2, 1, 2)], [(1, 2, 1, 2), (3,)])[0]) == [(0, 2), (1, 2), (1, 3), (2, 2)]
    assert repeats.locate([], [(1,), ()]) == [[], []]


def test_equal_windows_alone_share_a_number():
    rng = np.random.default_rng(1)
    for window in (1, 2, 3, 7, 20):
        for n in (0, 5, window, 400):
            words = rng.integers(0, 2, n)
            got = repeats._same_windows(words, window)
            want = [tuple(words[i : i + window].tolist()) for i in range(n - window + 1)]
            assert len(got) == len(want)
            assert len(set(got.tolist())) == len(set(want)) == len(set(zip(got.tolist(), want)))
