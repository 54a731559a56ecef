"""URL filters: host-suffix and path-prefix rules over any number of URLs.

Method: hash-prefix lookup.  Each URL is expanded into the expressions a rule
could have - label-aligned host suffixes times path prefixes - and the first
four bytes of each expression's SHA-256 are equi-joined with those of the
rules.  The few pairs that meet are confirmed on the whole digest, and the
longest rule of a URL wins (of two equally long, the one with the longer host,
then the greater text; of one rule with two verdicts, the greater word, so that
``block`` wins over ``allow``).  The suffix and prefix lengths that are tried are those
the rule table has, so the expansion is exact; they are data of one array
expression, so the plan does not grow with the rules.  Rules are
broadcast only if Spark's own size check allows it; else the join shuffles on
the hash prefix, which spreads hot hosts only as far as their expressions
differ, and adaptive execution splits what is left.

Decisions are joined back per distinct URL, so repeated URLs are judged once.

Defined results: a null URL or one without ``://`` has an empty host and path,
which no rule fits; repeated pages keep a row each; a URL of any length is
judged whole; a rule given twice counts once; other columns pass through, and
one named as an output gives way to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import lower_ascii

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    return spark.createDataFrame(rules, "verdict string, rule_host string, rule_path string")


def _digest(host: Column, path: Column) -> Column:
    """Digest of an expression; the blank keeps host and path apart."""
    return F.sha2(F.concat_ws(" ", host, path), 256)


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``."""
    keyed = rules.select("verdict", "rule_host", "rule_path", _digest(F.col("rule_host"), F.col("rule_path")).alias("rule_digest")).withColumn("short", F.substring("rule_digest", 1, 8))
    shape = rules.agg(
        F.sort_array(F.collect_set(F.size(F.split("rule_host", r"\.", -1)))).alias("labels"),
        F.sort_array(F.collect_set(F.length("rule_path"))).alias("lengths"),
    ).first()

    url = pages.select(F.col(url_col).alias("_url")).where(F.col("_url").contains("://")).distinct()
    parts = url.select("_url", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path"))
    labels, length = F.split("_host", r"\.", -1), F.length("_path")
    n = F.size(labels)
    numbers = lambda values: F.array(*map(F.lit, values)).cast("array<int>")
    hosts = F.transform(F.filter(numbers(shape.labels), lambda k: k <= n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    paths = F.transform(F.filter(numbers(shape.lengths), lambda k: k <= length), lambda k: F.substring("_path", 1, k))
    expressions = F.flatten(F.transform(hosts, lambda h: F.transform(F.col("_prefixes"), lambda p: _digest(h, p))))
    tried = parts.withColumn("_prefixes", paths).select("_url", F.explode(expressions).alias("digest"))
    met = tried.withColumn("short", F.substring("digest", 1, 8)).join(keyed, "short").where(F.col("digest") == F.col("rule_digest"))
    text = F.concat("rule_host", "rule_path")
    won = met.groupBy("_url").agg(
        F.max_by(F.struct(text.alias("rule"), "verdict"), F.struct(F.length(text), F.length("rule_host"), text, "verdict")).alias("_won")
    )
    return (
        pages.join(won, F.col(url_col) == F.col("_url"), "left")
        .withColumns({"host": host_of(F.col(url_col)), "path": path_of(F.col(url_col)), "rule": F.col("_won.rule"), "verdict": F.coalesce("_won.verdict", F.lit(default))})
        .drop("_url", "_won")
    )
