"""Registered queries: every operator over the driver's tables, with its SQL.

Each query is a thin use of the library; the SQL next to it says the same in
DuckDB's dialect.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from comarca import served_queries, table_queries
from comarca.functions import numbers, periods, text
from comarca.operators import aggregate, fallback, headed, joins, latest, layout, ordering, reshape, tables
from comarca.plans import geo, serving
from comarca.sources import delimited, files, lattice, sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {**served_queries.QUERIES, **table_queries.QUERIES}
ORACLES: dict[str, str] = {**served_queries.ORACLES, **table_queries.ORACLES}


def query(sql: str | None = None):
    def add(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _priority_rank():
    return joins.mapped(F.col("o_orderpriority"), {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1})


_RANK_SQL = "CASE o_orderpriority WHEN '1-URGENT' THEN 5 WHEN '2-HIGH' THEN 4 WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 1 END"


# -- aggregates ---------------------------------------------------------------

@query("""
SELECT l_suppkey,
       CAST(SUM(CASE WHEN l_returnflag = 'A' THEN l_linenumber ELSE 0 END) AS BIGINT) AS sum_a,
       CAST(SUM(CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END) AS BIGINT) AS sum_r,
       CAST(SUM(l_linenumber) AS BIGINT) AS sum_all
FROM lineitem GROUP BY l_suppkey""")
def cond_sum(spark, sf):
    flag = F.col("l_returnflag")
    return aggregate.conditional_sums(_t(spark, sf, "lineitem"), ["l_suppkey"], F.col("l_linenumber"), {"sum_a": flag == "A", "sum_r": flag == "R"}, "sum_all")


@query("""
SELECT p_brand,
       CAST(SUM(CASE WHEN p_type ILIKE '%brass%' OR p_type ILIKE '%steel%' THEN p_size ELSE 0 END) AS BIGINT) AS size_metal,
       CAST(SUM(CASE WHEN p_type ILIKE '%ECONOMY%' THEN p_size ELSE 0 END) AS BIGINT) AS size_economy,
       CAST(SUM(p_size) AS BIGINT) AS size_all
FROM part GROUP BY p_brand""")
def cond_sum_ilike(spark, sf):
    kind = F.col("p_type")
    cases = {"size_metal": text.contains_any(kind, ["brass", "steel"]), "size_economy": text.contains_any(kind, ["ECONOMY"])}
    return aggregate.conditional_sums(_t(spark, sf, "part"), ["p_brand"], F.col("p_size"), cases, "size_all")


@query("""
SELECT o_custkey, COUNT(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS n_f,
       COUNT(CASE WHEN o_orderpriority ILIKE '%high%' THEN 1 END) AS n_high, COUNT(*) AS n_all
FROM orders GROUP BY o_custkey""")
def cond_count(spark, sf):
    cases = {"n_f": F.col("o_orderstatus") == "F", "n_high": F.col("o_orderpriority").ilike("%high%")}
    return aggregate.conditional_counts(_t(spark, sf, "orders"), ["o_custkey"], cases, "n_all")


@query("""
SELECT o_orderstatus, COUNT(*) AS n, MIN(year(o_orderdate)) AS year FROM orders
WHERE year(o_orderdate) = (SELECT MAX(year(o_orderdate)) FROM orders WHERE year(o_orderdate) <= 1997)
GROUP BY o_orderstatus""")
def scalar_subquery_year(spark, sf):
    dated = _t(spark, sf, "orders").withColumn("year", F.year("o_orderdate").cast("bigint"))
    return aggregate.at_maximum(dated, "year", F.lit(1997)).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.min("year").alias("year"))


@query("""
SELECT l_suppkey, SUM(TRY_CAST(CASE WHEN l_linenumber % 3 = 0 THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END AS DOUBLE)) AS total
FROM lineitem GROUP BY l_suppkey""")
def sum_try_cast(spark, sf):
    raw = F.when(F.col("l_linenumber") % 3 == 0, "x").otherwise(F.col("l_linenumber").cast("string"))
    return _t(spark, sf, "lineitem").groupBy("l_suppkey").agg(F.sum(numbers.to_double(raw)).alias("total"))


@query("""
SELECT c_nationkey,
       COUNT(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS "AUTOMOBILE", COUNT(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS "BUILDING",
       COUNT(*) FILTER (WHERE c_mktsegment = 'NONE') AS "NONE", COUNT(c_mktsegment) AS total
FROM customer GROUP BY c_nationkey""")
def crosstab_total(spark, sf):
    return aggregate.crosstab(_t(spark, sf, "customer"), "c_nationkey", "c_mktsegment", ["AUTOMOBILE", "BUILDING", "NONE"])


@query("""
SELECT c_nationkey,
       CAST(coalesce(SUM(c_custkey) FILTER (WHERE c_mktsegment = 'AUTOMOBILE'), 0) AS BIGINT) AS "AUTOMOBILE",
       CAST(coalesce(SUM(c_custkey) FILTER (WHERE c_mktsegment = 'BUILDING'), 0) AS BIGINT) AS "BUILDING"
FROM customer GROUP BY c_nationkey""")
def pivot_counts(spark, sf):
    return aggregate.pivot_sums(_t(spark, sf, "customer"), ["c_nationkey"], "c_mktsegment", ["AUTOMOBILE", "BUILDING"], "c_custkey")


@query("SELECT c_nationkey, COUNT(DISTINCT c_mktsegment) AS n FROM customer GROUP BY c_nationkey")
def count_distinct(spark, sf):
    return _t(spark, sf, "customer").groupBy("c_nationkey").agg(F.countDistinct("c_mktsegment").alias("n"))


@query("SELECT o_orderpriority, COUNT(*) AS count FROM orders GROUP BY 1 ORDER BY count DESC, 1 LIMIT 3")
def value_counts_top(spark, sf):
    return aggregate.value_counts(_t(spark, sf, "orders"), "o_orderpriority", 3)


@query("""
SELECT round(AVG(a), 6) AS acctbal, round(AVG(n), 6) AS n
FROM (SELECT c_nationkey, AVG(c_acctbal) AS a, COUNT(*) AS n FROM customer GROUP BY 1)""")
def peer_mean(spark, sf):
    per = _t(spark, sf, "customer").groupBy("c_nationkey").agg(F.avg("c_acctbal").alias("acctbal"), F.count(F.lit(1)).alias("n"))
    return aggregate.peer_means(per, ["acctbal", "n"], 6)


@query("SELECT o_orderstatus, median(o_totalprice) AS middle FROM orders GROUP BY 1")
def median_by_group(spark, sf):
    counted = _t(spark, sf, "orders").groupBy("o_orderstatus", "o_totalprice").agg(F.count(F.lit(1)).alias("n"))
    return aggregate.grouped_medians(counted, ["o_orderstatus"], "o_totalprice", "n", "middle")


@query("""
SELECT l_suppkey, l_linenumber AS commonest FROM
 (SELECT l_suppkey, l_linenumber, row_number() OVER (PARTITION BY l_suppkey ORDER BY COUNT(*) DESC, l_linenumber) AS r FROM lineitem GROUP BY 1, 2)
WHERE r = 1""")
def mode_ties(spark, sf):
    return _t(spark, sf, "lineitem").groupBy("l_suppkey").agg(aggregate.mode_of(F.col("l_linenumber")).alias("commonest"))


@query("""
SELECT n_nationkey, n, n / SUM(n) OVER () AS share
FROM (SELECT c_nationkey AS n_nationkey, COUNT(*) AS n FROM customer GROUP BY 1)""")
def share_of_total(spark, sf):
    counts = _t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return aggregate.share_of_total(counts, "n")


@query("""
SELECT c_nationkey, round_even(SUM(c_acctbal) / COUNT(*), 6) AS ratio FROM customer GROUP BY 1""")
def rounded_ratio(spark, sf):
    per = _t(spark, sf, "customer").groupBy("c_nationkey").agg(F.sum("c_acctbal").alias("s"), F.count(F.lit(1)).alias("n"))
    return per.select("c_nationkey", numbers.rounded_ratio(F.col("s"), F.col("n")).alias("ratio"))


@query("""
SELECT o.* FROM orders o JOIN
 (SELECT o_custkey FROM orders GROUP BY o_custkey
  HAVING COUNT(*) >= 5 AND AVG(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1.0 ELSE 0.0 END) >= 0.3) g USING (o_custkey)""")
def quality_gate(spark, sf):
    return aggregate.gated(_t(spark, sf, "orders"), ["o_custkey"], F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 5, 0.3)


@query("SELECT MAX('Cut: ' || CAST(year(o_orderdate) AS VARCHAR)) AS raw, replace(MAX('Cut: ' || CAST(year(o_orderdate) AS VARCHAR)), 'Cut: ', '') AS label FROM orders")
def string_max_label(spark, sf):
    label = F.max(F.concat(F.lit("Cut: "), F.year("o_orderdate").cast("string")))
    return _t(spark, sf, "orders").agg(label.alias("raw")).withColumn("label", F.replace("raw", F.lit("Cut: "), F.lit("")))


# -- latest per key -----------------------------------------------------------

@query(f"""
SELECT o_custkey, o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC, {_RANK_SQL} DESC NULLS LAST, o_orderkey DESC) AS r FROM orders)
WHERE r = 1""")
def latest_per_key(spark, sf):
    values = {c: F.col(c) for c in ("o_orderkey", "o_totalprice")}
    return latest.latest_per(_t(spark, sf, "orders"), ["o_custkey"], [F.year("o_orderdate"), _priority_rank()], values, [F.col("o_orderkey")])


@query("""
SELECT o_custkey, o_orderkey, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN nullif(o_orderstatus, 'O') IS NOT NULL THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1""")
def latest_with_completeness(spark, sf):
    values = {c: F.col(c) for c in ("o_orderkey", "o_orderstatus")}
    done = latest.complete_first(F.nullif("o_orderstatus", F.lit("O")))
    return latest.latest_per(_t(spark, sf, "orders"), ["o_custkey"], [done, F.col("o_orderdate")], values, [F.col("o_orderkey")])


@query("""
SELECT c_nationkey, round(AVG(o_totalprice), 4) AS avg_latest, COUNT(*) AS n FROM (
  SELECT c_nationkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
  FROM orders JOIN customer ON o_custkey = c_custkey) WHERE r = 1 GROUP BY 1""")
def two_level_rollup(spark, sf):
    joined = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rollup = {"avg_latest": F.round(F.avg("o_totalprice"), 4), "n": F.count(F.lit(1))}
    return latest.two_level(joined, ["o_custkey"], ["c_nationkey"], [F.col("o_orderdate")], {"o_totalprice": F.col("o_totalprice")}, rollup, [F.col("o_orderkey")])


@query("""
SELECT o_custkey, o_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders WHERE year(o_orderdate) = 1996)
WHERE r = 1""")
def latest_in_year(spark, sf):
    year = _t(spark, sf, "orders").where(F.year("o_orderdate") == 1996)
    return latest.latest_per(year, ["o_custkey"], [F.col("o_orderdate")], {"o_orderkey": F.col("o_orderkey")}, [F.col("o_orderkey")])


# -- joins --------------------------------------------------------------------

def _nation_parts(spark, sf):
    nations = _t(spark, sf, "nation").select("n_nationkey", "n_name")
    customers = _t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    suppliers = _t(spark, sf, "supplier").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    return nations, customers, suppliers


@query("""
SELECT n_nationkey, n_name, customers, balance, suppliers, CAST(NULL AS DOUBLE) AS missing, CAST(NULL AS VARCHAR) AS missing_label
FROM nation
LEFT JOIN (SELECT c_nationkey, COUNT(*) AS customers, round(SUM(c_acctbal), 2) AS balance FROM customer GROUP BY 1) ON n_nationkey = c_nationkey
LEFT JOIN (SELECT s_nationkey, COUNT(*) AS suppliers FROM supplier GROUP BY 1) ON n_nationkey = s_nationkey""")
def star_left_null_fill(spark, sf):
    nations, customers, suppliers = _nation_parts(spark, sf)
    parts = [(customers, {"customers": "bigint", "balance": "double"}), (suppliers, {"suppliers": "bigint"}), (None, {"missing": "double", "missing_label": "string"})]
    return joins.star(nations, ["n_nationkey"], parts)


@query("""
WITH o AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS s FROM orders),
     b AS (SELECT s AS raw, COUNT(*) AS n FROM o GROUP BY 1)
SELECT o_orderkey, s, n FROM o LEFT JOIN b ON s IS NOT DISTINCT FROM raw""")
def null_safe_join(spark, sf):
    orders = _t(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("s"))
    return joins.null_safe_join(orders, orders.groupBy(F.col("s").alias("raw")).agg(F.count(F.lit(1)).alias("n")), {"s": "raw"})


@query("""
SELECT o_orderkey, band, label FROM orders
JOIN (VALUES (0, 'low', -1e300, 50000.0), (1, 'mid', 50000.0, 150000.0), (2, 'high', 150000.0, 1e300)) b(band, label, lo, hi) ON o_totalprice >= lo AND o_totalprice < hi""")
def band_lookup(spark, sf):
    band = joins.band_of(F.col("o_totalprice"), [50000, 150000])
    return _t(spark, sf, "orders").select("o_orderkey", band.alias("band"), joins.mapped(band, {0: "low", 1: "mid", 2: "high"}).alias("label"))


@query("""
WITH base AS (SELECT c_nationkey AS k, CAST(SUM(c_custkey) AS BIGINT) AS v, COUNT(*) AS w FROM customer GROUP BY 1),
     patch AS (SELECT s_nationkey AS k, CAST(SUM(s_suppkey) AS BIGINT) AS v FROM supplier WHERE s_acctbal > 0 GROUP BY 1)
SELECT base.k AS k, CASE WHEN (SELECT COUNT(*) FROM patch) > 0 THEN patch.v ELSE base.v END AS v, w FROM base LEFT JOIN patch ON base.k = patch.k""")
def overlay_patch(spark, sf):
    base = _t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.sum("c_custkey").alias("v"), F.count(F.lit(1)).alias("w"))
    patch = _t(spark, sf, "supplier").where("s_acctbal > 0").groupBy(F.col("s_nationkey").alias("k")).agg(F.sum("s_suppkey").alias("v"))
    return joins.overlay(base, patch, ["k"], ["v"])


@query("SELECT c_nationkey AS k, CAST(SUM(c_custkey) AS BIGINT) AS v FROM customer GROUP BY 1")
def overlay_empty_patch(spark, sf):
    base = _t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.sum("c_custkey").alias("v"))
    return joins.overlay(base, base.where("k < 0"), ["k"], ["v"])


@query("""
SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM (
  SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 1 END) AS r FROM orders)
WHERE r = 1 GROUP BY 1""")
def case_preference_top1(spark, sf):
    order = [F.when(F.col("o_orderstatus") == "P", 0).otherwise(1), F.col("o_orderkey")]
    return ordering.top_k_per(_t(spark, sf, "orders"), ["o_custkey"], order, 1).select("o_custkey", "o_orderkey")


@query("""
SELECT k, max_by(v, rank) AS v FROM (
  SELECT s_nationkey AS k, max(s_suppkey) AS v, 2 AS rank FROM supplier WHERE s_acctbal > 5000 GROUP BY 1
  UNION ALL SELECT c_nationkey, max(c_custkey), 1 FROM customer GROUP BY 1) GROUP BY k""")
def preferred_then_fallback(spark, sf):
    first = _t(spark, sf, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("k")).agg(F.max("s_suppkey").alias("v"))
    second = _t(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("k")).agg(F.max("c_custkey").alias("v"))
    return joins.preferred([first, second], ["k"])


@query("SELECT c_custkey FROM customer ANTI JOIN orders ON c_custkey = o_custkey")
def incremental_skip(spark, sf):
    done = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return sinks.unprocessed(_t(spark, sf, "customer").select("c_custkey"), done, "c_custkey")


# -- text and numbers ---------------------------------------------------------

@query("SELECT l_orderkey, l_linenumber, TRY_CAST(replace(replace(l_orderkey || '.' || l_linenumber || '00,' || l_linenumber, '.', ''), ',', '.') AS DOUBLE) AS v FROM lineitem")
def locale_double(spark, sf):
    raw = F.concat(F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string"), F.lit("00,"), F.col("l_linenumber").cast("string"))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.locale_double(raw).alias("v"))


@query("SELECT l_orderkey, l_linenumber, TRY_CAST(replace(replace(CASE WHEN l_linenumber = 3 THEN '-' ELSE l_orderkey || '.' || l_linenumber END, '.', ''), ',', '') AS BIGINT) AS v FROM lineitem")
def locale_bigint(spark, sf):
    raw = F.when(F.col("l_linenumber") == 3, "-").otherwise(F.concat_ws(".", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.locale_bigint(raw).alias("v"))


@query("""
SELECT l_orderkey, l_linenumber, TRY_CAST(CASE l_linenumber WHEN 1 THEN CAST(l_quantity / 2 AS VARCHAR) WHEN 2 THEN '1e3' WHEN 3 THEN '' WHEN 4 THEN '12,5' WHEN 5 THEN ' 12 ' ELSE '0' || l_orderkey END AS INTEGER) AS v FROM lineitem""")
def tolerant_int(spark, sf):
    n = F.col("l_linenumber")
    raw = F.when(n == 1, (F.col("l_quantity") / 2).cast("string")).when(n == 2, "1e3").when(n == 3, "").when(n == 4, "12,5").when(n == 5, " 12 ").otherwise(F.concat(F.lit("0"), F.col("l_orderkey").cast("string")))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.to_int(raw).alias("v"))


@query("SELECT doc_id, regexp_replace(lang || ',' || source || ',x', ',', '.') AS v FROM documents")
def first_comma_replace(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", numbers.first_comma_text(F.concat_ws(",", "lang", "source", F.lit("x"))).alias("v"))


@query("""
SELECT n_nationkey, trim(regexp_replace(regexp_replace(strip_accents(upper('  Región-de ' || n_name || ' Ñandú.')), '[^A-Z0-9 ]', ' ', 'g'), '\\s+', ' ', 'g')) AS key FROM nation""")
def geo_key(spark, sf):
    return _t(spark, sf, "nation").select("n_nationkey", text.geo_key(F.concat(F.lit("  Región-de "), F.col("n_name"), F.lit(" Ñandú."))).alias("key"))


@query("""
SELECT n_nationkey, CASE WHEN n_name IN ('ALGERIA', 'NATION_1') THEN 'ONE' ELSE upper(replace(n_name, '_', ' ')) END AS key FROM nation""")
def geo_key_alias(spark, sf):
    return _t(spark, sf, "nation").select("n_nationkey", text.geo_key(F.col("n_name"), {"ALGERIA": "ONE", "NATION 1": "ONE"}).alias("key"))


@query("""
SELECT l_orderkey, l_linenumber, (coalesce(nullif(l_discount, 0), 0) + coalesce(nullif(l_tax, 0), 0))
  / nullif((CASE WHEN l_discount <> 0 THEN 1 ELSE 0 END + CASE WHEN l_tax <> 0 THEN 1 ELSE 0 END), 0) AS mean FROM lineitem""")
def rowwise_mean(spark, sf):
    values = [F.nullif(c, F.lit(0.0)) for c in ("l_discount", "l_tax")]
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.row_mean(values).alias("mean"))


@query("""
SELECT l_orderkey, l_linenumber, level, CASE level WHEN 1 THEN 'Bajo' WHEN 2 THEN 'En proceso' WHEN 3 THEN 'Satisfactorio' ELSE 'Optimo' END AS label
FROM (SELECT l_orderkey, l_linenumber, CAST(least(4, greatest(1, round_even(l_quantity / 8, 0))) AS INTEGER) AS level FROM lineitem)""")
def round_clamp_label(spark, sf):
    score = F.col("l_quantity") / 8
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.score_level(score).alias("level"), numbers.score_label(score).alias("label"))


@query("""
SELECT o_orderkey, CASE WHEN x <= 5 THEN 'Sin riesgo' WHEN x <= 14 THEN 'Bajo' WHEN x <= 35 THEN 'Medio' WHEN x <= 80 THEN 'Alto' ELSE 'Inviable' END AS water,
       CASE WHEN x >= 90 THEN 'Optimo' WHEN x >= 75 THEN 'Aceptable' WHEN x >= 60 THEN 'Bajo' ELSE 'Critico' END AS coverage
FROM (SELECT o_orderkey, o_totalprice / 3000 AS x FROM orders)""")
def banded_class(spark, sf):
    x = F.col("o_totalprice") / 3000
    return _t(spark, sf, "orders").select("o_orderkey", numbers.water_risk(x).alias("water"), numbers.coverage_band(x).alias("coverage"))


@query("SELECT o_orderkey, format('{:,.1f}', o_totalprice) AS rate, format('{:.1f} %', o_totalprice / 1000) AS pct FROM orders")
def format_number(spark, sf):
    price = F.col("o_totalprice")
    return _t(spark, sf, "orders").select("o_orderkey", numbers.number_text(price, F.lit("pts")).alias("rate"), numbers.number_text(price / 1000, F.lit("%")).alias("pct"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'Pública' WHEN c_custkey % 4 = 1 THEN 'Privada' WHEN c_custkey % 4 = 2 THEN 'Mixta' END AS nature FROM customer""")
def legal_nature(spark, sf):
    raw = F.element_at(F.array(F.lit("Entidad PÚBLICA"), F.lit("privado"), F.lit("Mixta S.A."), F.lit("otra")), (F.col("c_custkey") % 4 + 1).cast("int"))
    return _t(spark, sf, "customer").select("c_custkey", text.legal_nature(raw).alias("nature"))


@query("SELECT n_nationkey, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS code FROM nation")
def padded_code(spark, sf):
    return _t(spark, sf, "nation").select("n_nationkey", numbers.padded_code(F.col("n_nationkey")).alias("code"))


@query(r"""
SELECT p_partkey, array_to_string([CASE WHEN i > 1 AND regexp_matches(t[i - 1], '\p{L}') THEN lower(t[i]) ELSE upper(t[i]) END FOR i IN range(1, len(t) + 1)], '') AS title
FROM (SELECT p_partkey, p_type || ' d.c. (a-b)' AS t FROM part)""")
def slug_title(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", text.title_case(F.concat(F.col("p_type"), F.lit(" d.c. (a-b)"))).alias("title"))


# -- periods ------------------------------------------------------------------

@query("""
SELECT event_id, CAST(len(list_filter([1, 5, 9, 13, 17, 21, 25, 29, 33, 37, 41, 45, 49], lambda s: week(ts) >= s)) AS INTEGER) AS period FROM events""")
def period_of_week(spark, sf):
    return _t(spark, sf, "events").select("event_id", periods.period_of_week(F.weekofyear("ts")).alias("period"))


@query("""
SELECT event_id, CAST(CASE WHEN p < 1 THEN y - 1 ELSE y END AS INTEGER) AS year, CAST(CASE WHEN p < 1 THEN 13 ELSE p END AS INTEGER) AS period
FROM (SELECT event_id, isoyear(ts) AS y, (week(ts) - 1) // 4 + 1 - 1 AS p FROM (SELECT event_id, ts FROM events) WHERE week(ts) < 53
      UNION ALL SELECT event_id, isoyear(ts), 12 FROM events WHERE week(ts) = 53)""")
def published_period(spark, sf):
    return _t(spark, sf, "events").select("event_id", periods.published_period(F.col("ts")).alias("p")).select("event_id", "p.year", "p.period")


@query("""
SELECT CAST(y AS INTEGER) AS year, CAST(p AS INTEGER) AS period, (['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII','XIII'])[p] AS name
FROM generate_series(2022, 2024) a(y), generate_series(1, 13) b(p) WHERE y < 2024 OR p <= 5""")
def period_calendar(spark, sf):
    return periods.period_calendar(spark, 2022, 2024, 5)


@query("""
SELECT o_orderkey, CASE WHEN m = 1 THEN 1 WHEN m = 2 THEN 4 WHEN m = 3 THEN 0 ELSE 12 END AS month, CASE WHEN m = 1 THEN 4 WHEN m = 2 THEN 0 ELSE 13 END AS period
FROM (SELECT o_orderkey, month(o_orderdate) AS m FROM orders)""")
def period_ranks(spark, sf):
    m = F.month("o_orderdate")
    month = F.when(m == 1, " enero ").when(m == 2, "Abril").when(m == 3, "x").otherwise("DICIEMBRE")
    period = F.when(m == 1, "IV").when(m == 2, " IV").otherwise("XIII")
    return _t(spark, sf, "orders").select("o_orderkey", periods.month_rank(month).alias("month"), periods.period_rank(period).alias("period"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y_%m') AS stamp, CAST(year(o_orderdate - INTERVAL 1 MONTH) AS INTEGER) AS year, CAST(month(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH) AS INTEGER) AS month FROM orders""")
def previous_month_stamp(spark, sf):
    day = F.col("o_orderdate")
    return _t(spark, sf, "orders").select("o_orderkey", periods.stamp(day).alias("stamp"), periods.previous_month(day).alias("p")).select("o_orderkey", "stamp", "p.year", "p.month")


@query("""
SELECT DISTINCT y AS year FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS y FROM orders UNION ALL SELECT CAST(year(l_shipdate) AS INTEGER) FROM lineitem)""")
def distinct_years(spark, sf):
    years = [_t(spark, sf, n).select(F.year(c).alias("year")) for n, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))]
    return years[0].union(years[1]).distinct()


# -- order --------------------------------------------------------------------

@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL ORDER BY c_acctbal DESC, c_custkey LIMIT 10")
def top_k(spark, sf):
    return ordering.top_k(_t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal"), "c_acctbal", 10, ["c_custkey"])


@query("SELECT n_nationkey, r FROM (SELECT n_nationkey, row_number() OVER (ORDER BY nullif(n_regionkey, 0) ASC NULLS LAST, n_nationkey) AS r FROM nation)")
def nulls_last_order(spark, sf):
    nations = _t(spark, sf, "nation").withColumn("k", F.nullif("n_regionkey", F.lit(0)))
    return nations.select("n_nationkey", F.row_number().over(Window.orderBy(F.asc_nulls_last("k"), "n_nationkey")).cast("bigint").alias("r"))


# -- reshape and sets ---------------------------------------------------------

@query("UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME name VALUE value")
def unpivot_measures(spark, sf):
    return reshape.melt(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


@query("""
SELECT id, sexo, edad, poblacion FROM (
  SELECT c_custkey AS id, 'HOMBRES' AS sexo, '0' AS edad, c_custkey AS poblacion FROM customer
  UNION ALL SELECT c_custkey, 'MUJERES', '100', c_custkey * 2 FROM customer WHERE c_custkey % 2 = 0)""")
def melt_counts(spark, sf):
    wide = _t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_custkey").cast("string").alias("Hombres 0"), F.when(F.col("c_custkey") % 2 == 0, (F.col("c_custkey") * 2).cast("string")).otherwise("n/a").alias("Mujeres 100 y más"), F.lit("9").alias("Total"))
    return reshape.melt_counts(wide, ["id"], r"^(Hombres|Mujeres)\s+(\d{1,3})", {"sexo": 1, "edad": 2})


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS name, c_mktsegment AS segment FROM customer
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL FROM supplier""")
def union_by_name(spark, sf):
    customers = _t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = _t(spark, sf, "supplier").select(F.col("s_name").alias("name"), F.concat(F.lit(""), F.col("s_suppkey").cast("string")).alias("key"))
    return files.union_by_name([customers, suppliers])


@query("SELECT DISTINCT c_nationkey, c_mktsegment FROM (SELECT * FROM customer UNION ALL SELECT * FROM customer)")
def union_distinct(spark, sf):
    customers = _t(spark, sf, "customer").select("c_nationkey", "c_mktsegment")
    return customers.unionByName(customers).dropDuplicates()


@query("""
SELECT n_nationkey, metric, amount, label FROM (
  UNPIVOT (SELECT n_nationkey, CAST(customers AS DOUBLE) AS customers, balance FROM (
    SELECT c_nationkey AS n_nationkey, COUNT(*) AS customers, round(SUM(c_acctbal), 2) AS balance FROM customer GROUP BY 1)) ON customers, balance INTO NAME metric VALUE amount)
JOIN (VALUES ('customers', 'Clientes'), ('balance', 'Saldo')) c(metric, label) USING (metric)""")
def tall_report(spark, sf):
    _, customers, _ = _nation_parts(spark, sf)
    catalogue = spark.createDataFrame([("customers", "Clientes"), ("balance", "Saldo")], "metric string, label string")
    return reshape.tall_report(customers, ["n_nationkey"], catalogue, ["customers", "balance"])


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k FROM events""")
def json_field(spark, sf):
    return _t(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("""
SELECT c_custkey, c_name AS a, CAST(c_custkey AS VARCHAR) AS b, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || '|' || 'x' || '|' || 'y' WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '' END AS c FROM customer""")
def tolerant_split(spark, sf):
    key = F.col("c_custkey")
    line = F.when(key % 3 == 0, F.concat_ws("|", "c_name", key.cast("string"), "c_mktsegment", F.lit("x"), F.lit("y"))).when(key % 3 == 1, F.concat_ws("|", "c_name", key.cast("string"), "c_mktsegment")).otherwise(F.concat_ws("|", "c_name", key.cast("string")))
    return _t(spark, sf, "customer").select("c_custkey", *(c.alias(n) for n, c in zip("abc", delimited.fitted(line, "|", 3))))


# -- layout -------------------------------------------------------------------

@query("""
SELECT conv_id, turn, role FROM (SELECT *, min(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS s FROM conversations)
WHERE turn >= coalesce(s, turn)""")
def positional_trim(spark, sf):
    rows = _t(spark, sf, "conversations").select("conv_id", F.col("turn").alias("row_no"), "role")
    return tables.from_first(rows, ["conv_id"], F.col("role").startswith("assistant")).withColumnRenamed("row_no", "turn")


@query("""
SELECT user_id, len(starts) AS islands, starts[1] AS first FROM (
  SELECT user_id, list(l ORDER BY l) AS starts FROM (
    SELECT user_id, l, l - (max(l + 3600) OVER (PARTITION BY user_id ORDER BY l, l + 3600 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1) >= 86400 AS b
    FROM (SELECT user_id, CAST(floor(epoch(ts)) AS DOUBLE) AS l FROM events)) WHERE coalesce(b, true) GROUP BY 1)""")
def gap_islands(spark, sf):
    left = F.floor(F.unix_timestamp("ts")).cast("double")
    words = _t(spark, sf, "events").select("user_id", left.alias("left"), (left + 3600).alias("right"))
    return layout.gap_starts(words, ["user_id"], 86400.0).select("user_id", F.size("starts").cast("bigint").alias("islands"), F.get("starts", F.lit(0)).alias("first"))


@query("""
WITH RECURSIVE w AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS r FROM events),
f AS (SELECT user_id, r, value AS anchor, 0 AS line FROM w WHERE r = 1
      UNION ALL
      SELECT w.user_id, w.r, CASE WHEN w.value - anchor > 5 THEN w.value ELSE anchor END, CASE WHEN w.value - anchor > 5 THEN line + 1 ELSE line END
      FROM f JOIN w ON w.user_id = f.user_id AND w.r = f.r + 1)
SELECT user_id, CAST(line AS INTEGER) AS line, COUNT(*) AS n FROM f GROUP BY 1, 2""")
def word_lines(spark, sf):
    words = _t(spark, sf, "events").select("user_id", F.col("value").alias("top"), F.col("event_id").cast("double").alias("x0"), F.col("event_type").alias("text"))
    return layout.word_lines(words, ["user_id"], 5.0).groupBy("user_id", "line").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, CASE WHEN x < 1500 THEN 0 WHEN x < 3000 THEN 1 ELSE 2 END AS place FROM (SELECT o_orderkey, o_totalprice / 50 AS x FROM orders)")
def midpoint_columns(spark, sf):
    starts = F.array(*map(F.lit, (1000.0, 2000.0, 4000.0)))
    return _t(spark, sf, "orders").select("o_orderkey", joins.midpoint_band(F.col("o_totalprice") / 50, starts).alias("place"))


# -- more of joins, filters and order -----------------------------------------

@query("""
SELECT c_custkey, s_suppkey FROM customer LEFT JOIN (SELECT s_nationkey, min(s_suppkey) AS s_suppkey FROM supplier GROUP BY 1) ON c_nationkey = s_nationkey""")
def first_writer_lookup(spark, sf):
    once = joins.first_per_key(_t(spark, sf, "supplier").withColumnRenamed("s_nationkey", "c_nationkey"), ["c_nationkey"], "s_suppkey")
    return _t(spark, sf, "customer").join(once, "c_nationkey", "left").select("c_custkey", "s_suppkey")


@query("""
SELECT count(k) AS matched, count(*) AS total, 100.0 * count(k) / count(*) AS pct
FROM orders LEFT JOIN (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_acctbal > 0) ON o_custkey = k WHERE o_custkey IS NOT NULL""")
def match_rate(spark, sf):
    known = _t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k")).distinct()
    met = _t(spark, sf, "orders").join(known, F.col("o_custkey") == F.col("k"), "left")
    return aggregate.match_rate(met, "o_custkey", "k").select("matched", "total", F.col("pct").cast("double").alias("pct"))


@query("SELECT p_partkey FROM part WHERE coalesce(p_type ILIKE '%brass%', false) OR p_size = 1")
def contains_or_code(spark, sf):
    return _t(spark, sf, "part").where(text.contains_or_code(F.col("p_type"), "brass", F.col("p_size"), 1)).select("p_partkey")


@query("""
SELECT o_orderkey, CASE round_even(x, 0) WHEN 1 THEN 'Bajo' WHEN 2 THEN 'En proceso' WHEN 3 THEN 'Satisfactorio' WHEN 4 THEN 'Optimo' ELSE 'N/D' END AS label
FROM (SELECT o_orderkey, o_totalprice / 50000 AS x FROM orders)""")
def unclamped_label(spark, sf):
    return _t(spark, sf, "orders").select("o_orderkey", numbers.score_label(F.col("o_totalprice") / 50000, clamp=False).alias("label"))


@query("""
SELECT o_orderkey, row_number() OVER (ORDER BY CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END DESC NULLS LAST, o_orderkey) AS place FROM orders QUALIFY place <= 50""")
def descending_missing_last(spark, sf):
    priced = _t(spark, sf, "orders").withColumn("v", F.when(F.col("o_orderstatus") == "F", float("nan")).otherwise(F.col("o_totalprice")))
    best = ordering.descending(priced, "v", "o_orderkey").limit(50)
    value = F.when(~F.isnan("v"), F.col("v"))
    return best.select("o_orderkey", F.row_number().over(Window.orderBy(value.desc_nulls_last(), "o_orderkey")).cast("bigint").alias("place"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)")
def latest_snapshot(spark, sf):
    stamped = _t(spark, sf, "orders").withColumn("snapshot", F.year("o_orderdate").cast("string"))
    return files.latest_snapshot(stamped).select("o_orderkey", "o_totalprice")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 3 <> 0")
def blank_rows_dropped(spark, sf):
    keep = F.col("o_orderkey") % 3 != 0
    return reshape.drop_blank_rows(_t(spark, sf, "orders").select(F.when(keep, F.col("o_orderkey")).alias("o_orderkey"), F.when(keep, F.col("o_custkey")).alias("o_custkey")))


@query("""
SELECT n_nationkey, CASE WHEN n_nationkey = n_regionkey THEN [1.0, 2.0] ELSE [1.0, 2.0, CAST(n_nationkey AS DOUBLE)] END::VARCHAR AS peers FROM nation""")
def peer_vector(spark, sf):
    vector = numbers.peers(F.lit(1.0), F.lit(2.0), F.col("n_nationkey").cast("double"), F.col("n_nationkey") == F.col("n_regionkey"))
    return _t(spark, sf, "nation").select("n_nationkey", F.concat(F.lit("["), F.array_join(F.transform(vector, lambda v: v.cast("string")), ", "), F.lit("]")).alias("peers"))


@query("SELECT conv_id, min(turn) AS turn FROM conversations WHERE lower(trim(role)) LIKE 'assist%' GROUP BY conv_id")
def header_match(spark, sf):
    rows = _t(spark, sf, "conversations").withColumn("cells", F.array("role"))
    return rows.where(tables.header_matches(F.col("cells"), ["Assist"])).groupBy("conv_id").agg(F.min("turn").alias("turn"))


# -- places, names of columns, layout, bands ----------------------------------

def _places(spark, sf):
    """Nations as towns, regions as regions."""
    joined = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return geo.towns(joined.select(F.col("r_regionkey").alias("codigo_dep"), F.col("r_name").alias("nombre_dep"), F.col("n_nationkey").cast("string").alias("codigo_mun"), F.col("n_name").alias("municipio")))


def _placed(spark, sf, table, key):
    """Rows of a table with untidy spellings of their places."""
    nations = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = _t(spark, sf, table).join(nations, F.col(key) == F.col("n_nationkey"))
    return rows.withColumns({"departamento": F.concat(F.lit("  "), F.lower("r_name")), "municipio": F.when(F.col("n_nationkey") % 7 != 3, F.concat(F.replace("n_name", F.lit(" "), F.lit("-")), F.lit(".")))})


@query("""
SELECT s_suppkey, r_regionkey AS geo_dep_codigo, CASE WHEN n_nationkey % 7 <> 3 THEN n_nationkey END AS geo_mun_codigo,
       CASE WHEN n_nationkey % 7 <> 3 THEN r_name END AS geo_dep_dane, CASE WHEN n_nationkey % 7 <> 3 THEN n_name END AS geo_mun_dane
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def conform_towns(spark, sf):
    made = geo.conform(_placed(spark, sf, "supplier", "s_nationkey"), geo.Place("departamento", "municipio"), _places(spark, sf), compat=False)
    return made.select("s_suppkey", "geo_dep_codigo", "geo_mun_codigo", "geo_dep_dane", "geo_mun_dane")


@query("""
SELECT c_custkey, r_regionkey AS geo_dep_codigo, r_name AS geo_dep_dane
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def conform_regions(spark, sf):
    made = geo.conform(_placed(spark, sf, "customer", "c_nationkey"), geo.Place("departamento"), _places(spark, sf), compat=False)
    return made.select("c_custkey", "geo_dep_codigo", "geo_dep_dane")


@query("""
SELECT c_custkey, n_regionkey AS geo_dep_codigo, n_nationkey AS geo_mun_codigo, r_name AS geo_dep_dane, n_name AS geo_mun_dane
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def conform_codes(spark, sf):
    made = geo.conform(_placed(spark, sf, "customer", "c_nationkey"), geo.Place("n_regionkey", "n_nationkey", codes=True), _places(spark, sf))
    return made.select("c_custkey", "geo_dep_codigo", "geo_mun_codigo", "geo_dep_dane", "geo_mun_dane")


@query("""
SELECT c_custkey, r_regionkey AS geo_dep_codigo
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def conform_fallback(spark, sf):
    rows = _placed(spark, sf, "customer", "c_nationkey")
    entity = rows.withColumns({"entidad": F.when(F.col("c_custkey") % 2 == 0, F.col("departamento")), "departamento": F.when(F.col("c_custkey") % 2 == 1, F.col("departamento"))})
    return geo.conform(entity, geo.Place("departamento", "municipio", fallback="entidad"), _places(spark, sf), compat=False).select("c_custkey", "geo_dep_codigo")


@query("""
SELECT r_name AS raw_dep, COUNT(DISTINCT n_nationkey) AS n_towns, MIN(n_nationkey) AS first_town
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""")
def place_bridge(spark, sf):
    nations = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    made = geo.bridge(nations.unionByName(nations), geo.Place("r_name", "n_name"), _places(spark, sf), compat=False)
    return made.groupBy("raw_dep").agg(F.count(F.lit(1)).alias("n_towns"), F.min("mun_codigo").alias("first_town"))


@query("SELECT n_regionkey AS dep_codigo, r_name AS dep_dane FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2")
def place_regions(spark, sf):
    return geo.regions(_places(spark, sf))


@query("SELECT n_nationkey AS codigo, n_name AS nombre_de_pais, n_regionkey AS region FROM nation")
def tidy_names(spark, sf):
    raw = _t(spark, sf, "nation").toDF(" n_nationkey ", "Nombre De Pais", " RegiÓn")
    named = reshape.renamed_if_present(reshape.trimmed_names(raw), {"n_nationkey": "codigo", "absent": "nothing"})
    return named.toDF(*text.unique_names([text.ascii_name(text.snake_name(c)) for c in reshape.ordered_unique(named.columns)]))


@query("""
SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity >= 30 THEN 3 WHEN l_quantity >= 20 THEN 2 WHEN l_quantity >= 10 THEN 1 ELSE 0 END AS place
FROM lineitem""")
def last_start_columns(spark, sf):
    starts = F.array(*(F.lit(float(x)) for x in (1, 10, 20, 30)))
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", layout.last_start(F.col("l_quantity"), starts).alias("place"))


@query("""
SELECT o_custkey, o_orderkey FROM orders
WHERE (CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) + (CASE WHEN o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END) + 1 >= 2""")
def filled_cells(spark, sf):
    cells = F.array(F.when(F.col("o_orderstatus") == "F", "x").otherwise(""), F.when(F.col("o_orderpriority") != "5-LOW", "y").otherwise(""), F.lit("z"))
    return layout.filled_rows(_t(spark, sf, "orders").withColumn("cells", cells)).select("o_custkey", "o_orderkey")


@query("""
SELECT s_suppkey, CAST(coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN s_suppkey END, 0) + s_nationkey AS BIGINT) AS total,
       s_suppkey % 3 = 0 AS missing, coalesce(CASE WHEN s_suppkey % 3 <> 0 THEN CAST(s_suppkey AS DOUBLE) END, -1.0) AS filled
FROM supplier""")
def row_sum_default(spark, sf):
    part = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_suppkey"))
    return _t(spark, sf, "supplier").select(
        "s_suppkey", numbers.row_sum([part, F.col("s_nationkey")]).cast("bigint").alias("total"),
        numbers.is_missing(part.cast("double")).alias("missing"), numbers.or_default(part.cast("string"), -1.0).alias("filled"))


@query("""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity <= 14 THEN 'good' WHEN l_quantity <= 35 THEN 'fair' ELSE 'danger' END AS alert,
       CASE WHEN l_quantity / 10 < 2 THEN 'low' WHEN l_quantity / 10 < 3 THEN 'fair' WHEN l_quantity / 10 < 3.5 THEN 'good' ELSE 'optimal' END AS average
FROM lineitem""")
def alert_bands(spark, sf):
    return _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", numbers.water_alert(F.col("l_quantity")).alias("alert"), numbers.average_band(F.col("l_quantity") / 10).alias("average"))


@query("""
SELECT n_name, upper(substr(lower(n_name), 1, 1)) || substr(lower(n_name), 2) || ' 2024' AS label FROM nation WHERE n_nationkey % 2 = 0
UNION ALL SELECT n_name, 'N/D' FROM nation WHERE n_nationkey % 2 = 1""")
def label_or_unknown(spark, sf):
    year = F.when(F.col("n_nationkey") % 2 == 0, 2024)
    return _t(spark, sf, "nation").select("n_name", text.period_label(F.col("n_name"), year).alias("label"))


@query("SELECT COUNT(*) AS n FROM lineitem")
def global_count(spark, sf):
    return _t(spark, sf, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW') AND NOT o_orderpriority ILIKE '%low%' AND o_totalprice > 0")
def membership_and_exclusion(spark, sf):
    rows = _t(spark, sf, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW") & ~text.contains_any(F.col("o_orderpriority"), ["low"]))
    return reshape.positive(rows, "o_totalprice").select("o_orderkey", "o_orderpriority")


@query("""
SELECT o_custkey, o_orderkey FROM
 (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS r FROM orders) WHERE r <= 2""")
def latest_two_per_key(spark, sf):
    return ordering.top_k_per(_t(spark, sf, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.col("o_orderkey")], 2).select("o_custkey", "o_orderkey")


@query("SELECT DISTINCT year(o_orderdate) AS year FROM orders UNION SELECT DISTINCT year(l_shipdate) FROM lineitem")
def available_years(spark, sf):
    frames = {"afiliacion": _t(spark, sf, "orders").select(F.year("o_orderdate").alias("anio")), "irca": _t(spark, sf, "lineitem").select(F.year("l_shipdate").alias("anio"))}
    return serving.available_years(frames).select(F.col("year").cast("bigint").alias("year"))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The shape of the region table: a star of aggregates with the latest-row rollup."""
    rolled = two_level_rollup(spark, sf).withColumnRenamed("c_nationkey", "n_nationkey")
    base = star_left_null_fill(spark, sf)
    return ordering.by_name(joins.star(base, ["n_nationkey"], [(rolled, {"avg_latest": "double", "n": "bigint"})]), "n_name")


# -- layout, drift and fallback -----------------------------------------------

@query("""
WITH w AS (
  SELECT l_orderkey, l_extendedprice / 1000 AS x, l_returnflag || CAST(l_linenumber AS VARCHAR) AS t FROM lineitem),
p AS (
  SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY x, t) AS place FROM w),
c AS (
  SELECT l_orderkey, x, t, CASE WHEN n > 4 AND place = 1 THEN 0 WHEN x >= 55 THEN 3 WHEN x >= 35 THEN 2 WHEN x >= 15 THEN 1 ELSE 0 END AS c FROM p),
g AS (SELECT l_orderkey, c, string_agg(t, ' ' ORDER BY x, t) AS t FROM c GROUP BY 1, 2)
SELECT l_orderkey, coalesce(max(CASE WHEN c = 0 THEN t END), '') AS c0, coalesce(max(CASE WHEN c = 1 THEN t END), '') AS c1,
       coalesce(max(CASE WHEN c = 2 THEN t END), '') AS c2, coalesce(max(CASE WHEN c = 3 THEN t END), '') AS c3
FROM g GROUP BY 1 HAVING count(*) >= 2""")
def surplus_words(spark, sf):
    """Orders as lines of words: short, exact, and longer than the four columns."""
    text_ = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
    lines = _t(spark, sf, "lineitem").select(F.lit(0).alias("page"), F.col("l_orderkey").alias("line"), (F.col("l_extendedprice") / 1000).alias("x0"), text_.alias("text"))
    starts = spark.range(1).select(F.lit(0).alias("page"), F.array(*map(F.lit, (5.0, 25.0, 45.0, 65.0))).alias("starts"))
    rows = layout.filled_rows(layout.cells_of_lines(lines, starts, ["page"]))
    return rows.select(F.col("line").alias("l_orderkey"), *(F.get("cells", F.lit(i)).alias(f"c{i}") for i in range(4)))


@query("""
WITH h AS (
  SELECT user_id, event_id AS top, lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) AS nxt, max_id
  FROM (SELECT *, max(event_id) OVER (PARTITION BY user_id) AS max_id FROM events) WHERE event_type = 'purchase'),
b AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY top) AS section, top + 1.0 AS y0, coalesce(nxt - 1.0, max_id) AS y1 FROM h)
SELECT e.event_id, b.user_id, CAST(b.section AS INTEGER) AS section
FROM events e JOIN b ON e.user_id = b.user_id AND e.event_id BETWEEN b.y0 AND b.y1 + 8 AND b.y0 <= b.y1 + 8""")
def section_window(spark, sf):
    """Events as a user's words from the top; each purchase heads a section."""
    events = _t(spark, sf, "events").select("user_id", "event_id", F.col("event_id").cast("double").alias("top"), F.lit(0.0).alias("x0"), F.col("event_type").alias("text"))
    lines = events.withColumn("line", F.col("event_id"))
    bounds = layout.section_bounds(lines, ["user_id"], "purchase")
    return layout.words_in_sections(events, bounds, ["user_id"]).select("event_id", "user_id", "section")


@query("""
SELECT l_orderkey, l_linenumber, p_partkey, p_size FROM lineitem JOIN part
  ON l_suppkey % 25 = p_size % 25 AND l_extendedprice BETWEEN p_retailprice AND p_retailprice + 100""")
def range_join(spark, sf):
    items = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_suppkey") % 25).alias("k"))
    parts = _t(spark, sf, "part").select("p_partkey", "p_size", (F.col("p_size") % 25).cast("long").alias("k"), F.col("p_retailprice").alias("lo"), (F.col("p_retailprice") + 100).alias("hi"))
    return joins.interval_join(items, parts, ["k"], "l_extendedprice", "lo", "hi", 100.0).select("l_orderkey", "l_linenumber", "p_partkey", "p_size")


@query("""
WITH e AS (
  SELECT user_id, event_id, CASE event_type WHEN 'purchase' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS rank FROM events),
n AS (SELECT user_id, rank, count(*) AS n FROM e GROUP BY 1, 2),
best AS (SELECT user_id, min(rank) AS rank FROM n WHERE n >= CASE rank WHEN 0 THEN 30 WHEN 1 THEN 20 ELSE 1 END GROUP BY 1)
SELECT e.user_id, e.event_id, CASE e.rank WHEN 0 THEN 'ruled' WHEN 1 THEN 'grid' ELSE 'text' END AS extractor
FROM e JOIN best ON e.user_id = best.user_id AND e.rank = best.rank""")
def fallback_chain(spark, sf):
    """Users as documents; three extractors, each with its own least number of rows."""
    events = _t(spark, sf, "events")

    def extractor(test, least):
        def extract(open_):
            rows = events.where(test).join(open_, "user_id", "left_semi").select("user_id", F.lit(0).alias("table"), F.col("event_id").alias("row_no"), F.array("event_type").alias("cells"))
            return fallback.gated(rows, ["user_id"], least)

        return extract

    kind = F.col("event_type")
    stages = [("ruled", extractor(kind == "purchase", 30)), ("grid", extractor(kind == "click", 20)), ("text", extractor(~kind.isin("purchase", "click"), 1))]
    return fallback.chain(events, stages, ["user_id"]).select("user_id", F.col("row_no").alias("event_id"), "extractor")


@query("""
SELECT user_id, page, n_rows FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY headed DESC, n_rows DESC, abs(page - 3), page) AS r FROM (
    SELECT user_id, event_id % 7 AS page, count(*) AS n_rows, arg_min(event_type, event_id) LIKE 'error%' AS headed FROM events GROUP BY 1, 2)) WHERE r = 1""")
def best_page(spark, sf):
    rows = _t(spark, sf, "events").select("user_id", (F.col("event_id") % 7).alias("page"), F.lit(0).alias("table"), F.col("event_id").alias("row_no"), F.array("event_type").alias("cells"))
    grades = fallback.table_grades(rows, ["user_id", "page", "table"], ["error"])
    return fallback.best_page(grades, ["user_id"], "page", F.lit(3)).select("user_id", "page", "n_rows")


@query("""
SELECT o_orderkey AS k, CAST(o_custkey AS DOUBLE) AS v, CAST(CAST(o_orderkey AS INTEGER) AS VARCHAR) AS s, NULL AS w FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT CAST(o_orderkey AS INTEGER), o_totalprice, o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT o_orderkey, CAST(CAST(o_custkey AS INTEGER) AS DOUBLE), NULL, o_orderpriority FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def widened_union(spark, sf):
    """Three layouts of the same set: whole numbers, doubles and texts under one name, columns that come and go."""
    orders, status = _t(spark, sf, "orders"), F.col("o_orderstatus")
    key = F.col("o_orderkey")
    frames = [
        orders.where(status == "F").select(key.alias("k"), F.col("o_custkey").alias("v"), key.cast("int").alias("s")),
        orders.where(status == "O").select(key.cast("int").alias("k"), F.col("o_totalprice").alias("v"), F.col("o_orderpriority").alias("s")),
        orders.where(~status.isin("F", "O")).select(key.alias("k"), F.col("o_custkey").cast("int").alias("v"), F.col("o_orderpriority").alias("w")),
    ]
    return lattice.union_widened(frames)


@query("""
SELECT c_nationkey, CAST(r AS INTEGER) AS row_no, c_name AS name, CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_custkey AS VARCHAR) END AS code, CASE WHEN c_nationkey % 2 = 1 THEN c_mktsegment END AS segment
FROM (SELECT *, 1 + row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer)""")
def headed_tables(spark, sf):
    """Nations as raw tables of two kinds of header, under a title."""
    even = F.col("c_nationkey") % 2 == 0
    number = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey")) + 1
    body = _t(spark, sf, "customer").select("c_nationkey", number.alias("row_no"), F.when(even, F.array(F.col("c_custkey").cast("string"), "c_name")).otherwise(F.array("c_name", "c_mktsegment")).alias("cells"))
    nations = body.select("c_nationkey").distinct()
    title = nations.select("c_nationkey", F.lit(0).alias("row_no"), F.array(F.lit("A title"), F.lit(None).cast("string")).alias("cells"))
    head = nations.select("c_nationkey", F.lit(1).alias("row_no"), F.when(even, F.array(F.lit("code "), F.lit("name"))).otherwise(F.array(F.lit("NAME"), F.lit("segment"))).alias("cells"))
    rows = title.unionByName(head).unionByName(body)
    named = headed.by_name(rows, headed.headers(rows, ["c_nationkey"], headed.filled(2), within=5), ["c_nationkey"])
    return named.select("c_nationkey", "row_no", F.col("name").alias("name"), "code", "segment")


@query("SELECT p_partkey, CASE WHEN p_size >= 0 AND p_size * 2.5 >= 90 THEN 'good' ELSE 'fair' END AS alert FROM part")
def coverage_alert(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", numbers.coverage_alert(F.col("p_size") * 2.5).alias("alert"))
