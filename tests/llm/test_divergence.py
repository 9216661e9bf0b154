from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from stockflow.llm import divergence
from tests.llm.rows import ODD, prose

DOCS = "doc_id long, text string, lang string, source string, rank int"


def plain(rows, least=10, ranks=10):
    """The audit over dense tables of counts."""
    table, docs, langs = {}, {}, {}
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        table.setdefault((lang, source), Counter()).update(terms)
        docs.setdefault(lang, Counter()).update(set(terms))
        langs.setdefault(lang, Counter()).update(terms)
    out = []
    gap = lambda p, q: (p - q) ** 2 // (p + q)
    for lang, seen in docs.items():
        kept = [w for w, n in seen.items() if n >= least]
        v = len(kept)
        sources = [s for l, s in table if l == lang]
        share = {}
        for s, counts in [*((s, table[lang, s]) for s in sources), (None, langs[lang])]:
            total = sum(counts[w] for w in kept)
            share[s] = {w: 1 + 1_000_000_000 * (counts[w] + 2) // (total + 2 * v) for w in kept}
        for s in sources:
            pairs = [(sum(gap(share[s][w], share[t][w]) for w in kept), t) for t in sources if t != s]
            for rank, (value, t) in enumerate(sorted(pairs, key=lambda x: (-x[0], x[1].encode())), 1):
                out.append((lang, s, "pair", t, value, rank))
            mine = [w for w in kept if table[lang, s][w] and share[s][w] > share[None][w]]
            found = sorted((-gap(share[s][w], share[None][w]), w.encode()) for w in mine)
            for rank, (value, w) in enumerate(found[:ranks], 1):
                out.append((lang, s, "term", w.decode(), -value, rank))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], DOCS)


def corpus(seed=5):
    rng = random.Random(seed)
    rows = [(i, t, "en", "s") for i, t in ODD]
    for i in range(400):
        lang = rng.choice(["en", "en", "de", "", None])
        source = rng.choice(["hot"] * 5 + ["a", "B", "é", "", None, "zz"])
        rows.append((i, prose(i % 90, rng.randrange(80)) + " Ünï-Été don't A_b" * rng.randrange(3), lang, source))
    return rows + [(1, "only few here", "xx", "one"), (2, None, "xx", "two"), (3, "", "yy", "lonely")]


def test_whole_result(spark):
    rows = corpus()
    assert sorted(map(tuple, divergence.audit(frame(spark, rows)).collect())) == plain(rows)


def test_small_blocks_flushes_and_thinning(spark, monkeypatch):
    """Bounds that are passed many times change nothing; workers get them by value."""
    rows = corpus(6)
    docs = frame(spark, rows).repartition(3)
    counts = Counter()
    for r in divergence.term_counts(docs).collect():
        counts[r["lang"], r["source"], r["term"]] += r["n"]
    text = ("Été a-b " * 300_000)[:-1]
    assert divergence._terms(np.frombuffer(text.encode(), np.uint8)) == Counter(
        {"Été".encode(): 300_000, b"a": 300_000, b"b": 300_000}
    )
    assert sum(counts.values()) == sum(
        len(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t or "")) for _, t, _, _ in rows
    )


def test_skyband_keeps_what_fewer_than_k_dominate():
    rng = random.Random(8)
    for n in (0, 1, 5, 300):
        terms = [f"w{i:03}".encode() for i in range(n)]
        rng.shuffle(terms)
        count = np.array([rng.randrange(8) for _ in terms], dtype=np.int64)
        whole = np.array([rng.randrange(30) for _ in terms], dtype=np.int64)
        for k in (1, 3, 10):
            want = [
                i
                for i in range(n)
                if sum(count[j] >= count[i] and whole[j] <= whole[i] and terms[j] < terms[i] for j in range(n)) < k
            ]
            assert divergence.thin(terms, count, whole, k).tolist() == want


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [])).collect() == []
