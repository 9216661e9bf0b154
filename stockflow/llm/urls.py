"""URL filter: host-suffix and path-prefix expressions, joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX_DIGITS = 8


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules as (verdict, host, path); a path is empty or begins with a slash."""
    return spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL; both empty without ``://`` or for null."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _expressions(places: DataFrame, lengths: list[int]) -> DataFrame:
    """Every host suffix with every path prefix of a length that some rule has."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    prefixes = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path_head")),
        lambda n: F.substring(F.col("path_head"), F.lit(1), n),
    )
    return (
        places.select("host", "path_head", F.explode(suffixes).alias("suffix"), prefixes.alias("prefixes"))
        .select("host", "path_head", "suffix", F.explode("prefixes").alias("prefix"))
        .select("host", "path_head", _digest(F.concat("suffix", "prefix")).alias("digest"))
    )


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", default: str = "allow") -> DataFrame:
    """Each page's host, path, the rule that decides and the verdict.

    A rule fits its host and all subdomains where the path starts with the rule's path. Of the
    rules that fit, the longest text wins, then the longer host, then ``block``. Without a fitting
    rule ``rule`` is null and the verdict is ``default``. A null URL has an empty host and path;
    an empty table gives an empty result; repeated rows are judged alike and all returned; other
    columns of ``pages`` are ignored.

    Only the distinct (host, path head) pairs are expanded, where the head is as long as the
    longest rule path: a hot host collapses before the join. The distinct rule-path lengths are
    the one thing collected; URL lengths bound their number.
    """
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect())
    host, path = host_and_path(F.col("url"))
    places = pages.select(F.col(key), host.alias("host"), path.alias("path")).withColumn(
        "path_head", F.substring("path", 1, max(lengths, default=0))
    )
    if not lengths:
        lengths = [0]
    text = F.concat("rule_host", "rule_path")
    wanted = rules.select(
        text.alias("rule"), "verdict", F.length("rule_host").alias("host_length"), _digest(text).alias("rule_digest")
    ).withColumn("short", F.substring("rule_digest", 1, PREFIX_DIGITS))
    expanded = _expressions(places.select("host", "path_head").distinct(), lengths)
    fits = (
        expanded.withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
        .join(wanted, "short")
        .filter(F.col("digest") == F.col("rule_digest"))
    )
    order = F.struct(F.length("rule"), F.col("host_length"), F.col("verdict"))
    best = (
        fits.groupBy("host", "path_head")
        .agg(F.max_by(F.struct("rule", "verdict"), order).alias("won"))
        .select("host", "path_head", "won.rule", "won.verdict")
    )
    return places.join(best, ["host", "path_head"], "left").select(
        key, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
