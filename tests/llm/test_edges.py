"""Nulls, empty and long texts, ties, repeats, empty tables and clashing columns, for every operator."""

from __future__ import annotations

import pytest

import corpus_pipeline
from stockflow.llm import decontaminate, extract, packing, quality, repeats, rules, sharding, simhash, toxicity, urls
from tests.llm.rows import ODD, documents

LABELS = "doc_id long, quality int, toxic int"


def _labels(spark, rows=((3, 0, 1), (5, 1, 0), (5, 0, 0), (6, 0, 1), (7, 1, 0), (None, 1, 1), (8, None, None))):
    return spark.createDataFrame(list(rows), LABELS)


def _benchmark(spark, rows=((1, "river"), (2, None), (None, "x y"), (3, "...!"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "quality": lambda s, d: quality.classify(d, _labels(s)),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "sharding": lambda s, d: sharding.shard_documents(d),
    "repeats": lambda s, d: repeats.removals(d),
    "toxicity": lambda s, d: toxicity.score(d, _labels(s), slots=1 << 12),
    "rules": lambda s, d: rules.apply(d, _labels(s)),
    "decontaminate": lambda s, d: decontaminate.verdicts(d, _benchmark(s)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_gets_a_result(spark, name):
    docs = documents(spark, ODD, "kept")
    got = OPERATORS[name](spark, docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in ODD)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, documents(spark, [])).collect() == []


def test_packing_edges(spark):
    got = packing.pack(documents(spark, ODD, "length")).collect()
    first = [r["doc_tokens"] for r in got if r["start"] == 0]
    assert len(first) == len(ODD) and sum(r["length"] for r in got) == sum(first)
    assert packing.pack(documents(spark, [])).collect() == []


def test_no_labels_rejects_nothing(spark):
    docs = documents(spark, [(1, "a b c"), (2, "d e f")])
    none = spark.createDataFrame([], LABELS)
    assert [r["kept"] for r in quality.classify(docs, none).collect()] == [True, True]
    assert {r["predicted"] for r in toxicity.score(docs, none, slots=1 << 12).collect()} == {0}


def test_pages_edges(spark):
    schema = "page_id long, url string, html string, text string, rule string"
    rows = [(1, None, None, "t", "r"), (2, "x", "", "t", "r"), (None, "://", "<p", "t", "r"), (3, "http://A.b?", "<article>a", "t", "r")]
    pages = spark.createDataFrame(rows, schema)
    assert sorted(r["text"] for r in extract.extract(pages).collect()) == ["", "", "", "a"]
    table = urls.rule_table(spark, [("block", "b", "")])
    got = {r["host"]: (r["path"], r["rule"], r["verdict"]) for r in urls.judge(pages, table).collect()}
    assert got == {"": ("", None, "allow"), "a.b": ("", "b", "block")}
    empty = spark.createDataFrame([], schema)
    assert extract.extract(empty).collect() == [] == urls.judge(empty, table).collect()
    assert urls.judge(pages, urls.rule_table(spark, [])).count() == 4


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_return_the_columns_they_get(spark, stage, tmp_path):
    _labels(spark).write.parquet(f"{tmp_path}/labels.parquet")
    _benchmark(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, ODD, "evidence")
    got = stage[1](spark, docs, str(tmp_path))
    assert got.dtypes == docs.dtypes
    assert 0 < got.count() <= len(ODD)
    assert stage[1](spark, documents(spark, []), str(tmp_path)).collect() == []
