from __future__ import annotations

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from stockflow.llm import clusters

SCHEMA = "vec_id long, embedding array<double>, cluster int"


def vectors(n: int, seed: int = 1, size: int = 64) -> list[list[float]]:
    rng = random.Random(seed)
    heads = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(5)]
    return [[h + rng.gauss(0, 0.2) for h in rng.choice(heads)] for _ in range(n)]


def plain(rows, k=8, rounds=10):
    """Plain k-means over whole numbers."""
    kept = [
        (i, tuple(math.floor(Fraction(x) * 1024) for x in v))
        for i, v in rows
        if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [v for _, v in named[:k]]

    def assign(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        of = [assign(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, of) if c == n]
            if mine:
                centroids[n] = tuple(sum(x) // len(mine) for x in zip(*mine))
    found = [(i, *assign(v)) for i, v in kept]
    fits = lambda x: x if x < 1 << 63 else None
    return sorted(
        [
            (
                i, n, fits(d), fits(sum(e for _, e, m in found if m == n)), fits(sum(e for _, e, _ in found)),
                hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest(),
            )
            for i, d, n in found
        ],
        key=str,
    )


def test_transform_keeps_distances():
    rng = np.random.default_rng(2)
    x = rng.integers(-5000, 5000, (20, 64))
    t = clusters.transform(x)
    assert ((t[0] - t[1:]) ** 2).sum(axis=1).tolist() == (64 * ((x[0] - x[1:]) ** 2).sum(axis=1)).tolist()
    assert (t[:, 0] == x.sum(axis=1)).all()
    one = clusters.transform(np.eye(64, dtype=np.int64))
    changes = (np.diff(one, axis=0) != 0).sum(axis=0)
    assert changes.tolist() == list(range(64))


def test_nearest_with_ties_and_wide_numbers():
    rng = np.random.default_rng(3)
    c = rng.integers(-3, 3, (8, 64))
    c[5] = c[2]
    x = np.concatenate([c, rng.integers(-3, 3, (200, 64))])
    full = ((x[:, None] - c[None]) ** 2).sum(axis=2)
    for kind, scale in ((np.int64, 1), (object, 10**40)):
        at, distance = clusters.nearest(x.astype(kind) * scale, c.astype(kind) * scale)
        assert at.tolist() == full.argmin(axis=1).tolist()
        assert distance.tolist() == [d * scale**2 for d in full.min(axis=1).tolist()]


@pytest.mark.parametrize("n", [0, 3, 400])
def test_whole_result(spark, n):
    rows = [(i, v) for i, v in enumerate(vectors(n))]
    if n > 3:
        rows += [(7, rows[7][1]), (7, vectors(1, 9)[0]), (None, rows[1][1]), (900, None), (901, []), (902, rows[0][1][:63])]
        rows += [(903, [None] + rows[0][1][1:]), (904, [math.nan] + rows[0][1][1:]), (905, [-math.inf] + rows[0][1][1:])]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, clusters.cluster(table).collect()), key=str) == plain(rows)


def test_huge_components(spark):
    rows = [(i, v) for i, v in enumerate(vectors(30))] + [(50, [1e300] * 64), (51, [-4e9] * 64), (52, [1.7e308] * 64)]
    table = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert sorted(map(tuple, clusters.cluster(table).collect()), key=str) == plain(rows)
