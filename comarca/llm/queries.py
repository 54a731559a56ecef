"""Registered queries of the operators, each over its whole table.

Every query gets its rows through its operator and derives the contract's
columns from them.  ``ORACLES`` holds DuckDB SQL where SQL can say the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, divergence, mixing, private_data, quality, secret_scan, shards, simhash, suffixes, token_counts, topk, urls, variants
from .common import table

#: Rules of the URL query: verdict, host, path.
URL_RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = token_counts.token_counts(docs, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = topk.top_k(vectors, F.pmod("vec_id", F.lit(50)) == 0, k=5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge(pages, urls.rule_table(spark, URL_RULES)).select("page_id", "host", "path", "rule", "verdict")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    dealt = shards.shuffle_into_shards(docs, 16)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, outputs=("n_tokens", "ids_sha256", "decoded_sha256"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs, 200, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(mixing.sizes(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return grouped.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.scan(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = variants.word_counts(table(spark, sf_dir, "documents"), typo_every=199)
    return variants.group_variants(counts).select("word", "form", "root", "n", "n_near", "form_n")


def op12_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = private_data.scan(docs, model=private_data.fit(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_url_filters": op3_url_filters,
    "op4_sharding": op4_sharding,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_mixing": op8_mixing,
    "op9_simhash": op9_simhash,
    "op10_secret_scan": op10_secret_scan,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_private_data": op12_private_data,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op2_exact_top_k": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5""",
    "op3_url_filters": r"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
fit AS (
  SELECT p.*,
         host = 'org' OR ends_with(host, '.org') AS in_org,
         host = 'example.org' OR ends_with(host, '.example.org') AS in_example,
         host = 'com' OR ends_with(host, '.com') AS in_com
  FROM p),
ruled AS (
  SELECT page_id, host, path,
         CASE WHEN in_example AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN in_example AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN in_com AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN in_com AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN in_org AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM fit)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
    # texts as terms, every kept term of a language for every source, all in whole numbers
    "op13_source_divergence": r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x60\x7B-\x7F]+') AS ts
  FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(ts) AS term FROM d) GROUP BY ALL),
df AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(ts)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 3),
k AS (SELECT c.lang, c.term, CAST(sum(n) AS BIGINT) AS ln FROM c JOIN df ON df.lang = c.lang AND df.term = c.term GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(ln) AS m FROM k GROUP BY ALL),
full_ AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.ln, l.v, l.m
  FROM g JOIN k ON k.lang = g.lang JOIN l ON l.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + v) AS p,
         1 + (1000000000::HUGEINT * (ln + 1)) // (m + v) AS q
  FROM full_),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 200""",
}
