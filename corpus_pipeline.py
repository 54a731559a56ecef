"""A training corpus from ``documents``: quality, near duplicates, secrets, mixing, tokens.

Each stage is one operator of :mod:`comarca.llm` over all that its predecessor
kept; what a stage returns is written as Parquet and read again before the
next.  All stages but the last return the columns of ``documents``; columns
beyond those are dropped by them, whatever their names, and pass the last.  An
empty table gives no rows in any stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comarca.llm import bpe, mixing, near_copies, quality, secret_scan
from comarca.llm.common import durable, sieve_mark, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _row_keys() -> dict[str, Column]:
    """128 bits of a row's id and text: a null-safe join key."""
    return {"_k": F.xxhash64("doc_id", "text"), "_l": F.xxhash64(F.lit(1), "doc_id", "text")}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the others keep their passing lines.

    Null, empty and short texts are rejected; repeated rows are judged each.
    """
    judged = quality.judge(docs, keep_text=True).where("kept")
    return judged.withColumn("text", F.col("cleaned")).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id.

    Null ids come last; null, empty and blank texts are one group; of rows that
    repeat whole in id and text one stays.
    """
    keyed = docs.select(*COLUMNS).withColumns(_row_keys())
    grouped = near_copies.near_copies(keyed, ("_k", "_l"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_k", "_l"))
    stays = grouped.groupBy("group").agg(first.alias("f")).select("f._k", "f._l", F.lit(True).alias("_stays"))
    times = grouped.groupBy("_k", "_l").agg(F.count(F.lit(1)).alias("_n"))
    # only what goes or repeats is held against the texts; the rest passes as it is
    changed = durable(times.join(stays, ["_k", "_l"], "left").where("_stays IS NULL OR _n > 1"), "near-changed")
    sifted = sieve_mark(keyed, "_k", changed)
    held = sifted.where("_may")
    single = held.join(changed.hint("merge"), ["_k", "_l"], "left_anti")
    repeated = held.dropDuplicates(["_k", "_l"]).join(changed.where("_stays").hint("merge"), ["_k", "_l"], "left_semi")
    single = sifted.where("NOT _may").unionByName(single)
    return single.unionByName(repeated).select(*COLUMNS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become their kind in brackets; every document stays, a null text as ''."""
    return secret_scan.scan(docs, redact=True).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it; rows that repeat share their copies."""
    whole = [*COLUMNS, *(F.col(c).isNull() for c in COLUMNS)]
    keyed = docs.withColumn("_k", F.concat(F.hex(F.xxhash64(*whole)), F.lit("-"), F.hex(F.xxhash64(F.lit(1), *whole))))
    mixed = mixing.mix(mixing.sizes(keyed, id_col="_k"), id_col="_k").groupBy("_k").agg(F.sum("copies").alias("copies")).where("copies > 0")
    rows = keyed.dropDuplicates(["_k"]).join(mixed, "_k")  # rows that repeat share a key and the sum of their copies
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*COLUMNS)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digest of what they decode to; none for null and empty texts."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, path, public_tokenizers.PATTERN, outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("mix_sources", mix_sources),
    ("encode_tokens", encode_tokens),
]

#: Fingerprints, balanced samples and tokens are beyond SQL; tests hold the
#: stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
