from __future__ import annotations

import hashlib
import random
import re

import pytest

from stockflow.llm import decontaminate
from tests.llm.rows import documents, prose

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, items):
    windows = {}
    for name, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(str(name))
    out = {}
    for i, text in rows:
        w, hit, names = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                found = windows.get(tuple(w[k : k + n]))
                if found:
                    names |= found
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out[i] = len(w), len(hit), len(names), digest, bool(hit) and 20 * len(hit) >= len(w)
    return out


def cases():
    rng = random.Random(3)
    items = [(i, prose(i, rng.choice([5, 12, 13, 14, 40]))) for i in range(20)]
    items += [(20, "river"), (21, items[4][1] + " and more " + prose(99, 20)), (22, "a b a b a b a b a b a b a b a b a"), (23, "…!")]
    rows = []
    for i in range(80):
        part = rng.choice(items)[1].split()
        a = rng.randrange(0, len(part))
        rows.append((i, f"{prose(1000 + i, rng.randrange(200))} {', '.join(part[a:]).upper()}. {prose(2000 + i, 9)}"))
    return rows + [(80, None), (81, "a B " * 30), (82, items[4][1])], items


@pytest.mark.parametrize("block", [1 << 20, 300])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    rows, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string")
    names = ["n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in decontaminate.verdicts(documents(spark, rows), table).collect()}
    assert got == plain(rows, items)
    kept = {r["doc_id"] for r in decontaminate.decontaminate(documents(spark, rows), table).collect()}
    assert kept == {i for i, v in got.items() if not v[4]}


def test_a_batch_builds_each_automaton_once(spark, monkeypatch):
    """However many blocks there are beyond those that are kept."""
    import pyarrow as pa

    rows, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string")
    computed, built, block = [], [], decontaminate.Block
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 300)
    monkeypatch.setattr(decontaminate, "annotate", lambda docs, keep, fields, compute: computed.append(compute) or docs.selectExpr("1L AS n_hit", "1L AS n_words"))
    monkeypatch.setattr(decontaminate, "Block", lambda *a: built.append(1) or block(*a))
    decontaminate.scan(documents(spark, rows), table, ["doc_id"])
    got = computed[0](pa.array([t for _, t in rows], pa.string()))
    want = plain(rows, items)
    assert got["n_hit"] == [want[i][1] for i, _ in rows]
    size = sum(len((t or "").encode()) for _, t in items)
    assert decontaminate.KEPT < len(built) == -(-size // 300)


def test_without_short_items_pairs_filter(spark):
    rows, items = cases()
    items = [x for x in items if len(words(x[1])) >= 13]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["items_sha256"]) for r in decontaminate.verdicts(documents(spark, rows), table).collect()}
    assert got == {i: (v[1], v[3]) for i, v in plain(rows, items).items()}


def test_clean_texts_cut_the_spans(spark):
    item = prose(5, 15)
    table = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, [(1, f"é before {item} after"), (2, "nothing here"), (3, None)])
    got = {r["row"]["doc_id"]: r["clean_text"] for r in decontaminate.clean_texts(docs, table, ["doc_id"]).collect()}
    assert got == {1: "é before  after", 2: "nothing here", 3: None}
