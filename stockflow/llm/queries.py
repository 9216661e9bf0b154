"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stockflow.llm import (
    clusters,
    decontaminate,
    divergence,
    extract,
    packing,
    quality,
    repeats,
    rules,
    secrets,
    sharding,
    simhash,
    toxicity,
    urls,
)

#: Fixed values of the URL filter: verdict, host, path.
URL_RULES = [
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(_table(spark, sf_dir, "pages"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removals(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters.cluster(_table(spark, sf_dir, "embeddings"))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        op1_quality_classifier,
        op2_simhash_near_dedup,
        op3_html_extraction,
        op4_sharding,
        op5_url_filters,
        op6_substring_dedup,
        op7_toxicity,
        op8_quality_rules,
        op9_decontamination,
        op10_packing,
        op11_source_divergence,
        op12_centroid_clustering,
        op13_secret_scan,
        pipeline,
    ]
    return {q.__name__: q for q in named}
