from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import xxhash

from stockflow.llm import simhash
from stockflow.llm.components import components
from tests.llm.rows import documents, prose


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            a, b = sorted((find(i), find(j)))
            root[b] = a
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    for text in (None, "", "A b", "a B c d", prose(3, 500), "É é A\x0bB \x1c", "x " * 70_000):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(5)
    for level in range(4):
        found = [m & (1 << 64) - 1 for m in simhash.masks(4, level)]
        assert len(found) == 31
        for _ in range(3000):
            difference = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not difference & m for m in found)


def test_spanning_links_connect_what_pairs_connect():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 62, 6, dtype=np.int64)
    prints = np.unique(np.concatenate([b ^ (1 << rng.integers(0, 62, 40)) ^ (1 << rng.integers(0, 62, 40)) for b in base]))
    found = simhash.spanning_links(prints, 4)
    assert len(found) < len(prints)
    root = list(range(len(prints)))
    for _ in prints:
        for a, b in found:
            root[a] = root[b] = min(root[a], root[b])
    assert root == plain_components([int(p) for p in prints])


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "u long, v long")
    got = dict(components(links).collect())
    assert got == {**{i: 0 for i in range(301)}, 1000: 1000, 1001: 1000}


def test_large_buckets_are_hashed_again(spark):
    """A group whose buckets pass the limit gives the same components as brute force."""
    rng = random.Random(2)
    prints = {0x1234}
    while len(prints) < 150:
        p = rng.choice(sorted(prints))
        for b in rng.sample(range(64), rng.choice([1, 2, 3])):
            p ^= 1 << b
        prints.add(p)
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.links(spark.createDataFrame(signed, "fp long"), 4, bucket=8)
    found = {n & (1 << 64) - 1: c for n, c in components(links).collect()}
    groups = plain_components(prints)
    for i, j in combinations(range(len(prints)), 2):
        same = found.get(prints[i], prints[i]) == found.get(prints[j], prints[j])
        assert same == (groups[i] == groups[j])


def test_near_duplicates_and_keep_one(spark):
    base = prose(7, 400)
    rows = [(9, base), (4, base + " end"), (6, prose(8, 50)), (2, None), (3, " "), (None, base), (6, prose(8, 50))]
    docs = documents(spark, rows)
    got = [(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in simhash.near_duplicates(docs).collect()]
    prints = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(prints)
    want = []
    for (i, t), p, g in zip(rows, prints, groups):
        ids = [j for (j, _), h in zip(rows, groups) if h == g and j is not None]
        want.append((i, p, min(ids)))
    assert sorted(got, key=str) == sorted(want, key=str)
    kept = sorted(r["doc_id"] for r in simhash.keep_one(docs).collect())
    assert kept == sorted({w[2] for w in want})
