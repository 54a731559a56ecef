"""Registered queries of raw tables and page layout: cells, lines, column starts, sheets melted, registers counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from comarca.operators import layout, tables
from comarca.plans import population, providers, scorecards


def _t(spark, sf, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def entity_section(spark, sf) -> DataFrame:
    """Events as a user's lines: from the first click under the first purchase."""
    lines = _t(spark, sf, "events").select("user_id", F.col("event_id").alias("line"), F.col("event_id").cast("double").alias("top"), F.lit(0.0).alias("x0"), F.col("event_type").alias("text"))
    return layout.from_entity(lines, ["user_id"], ["Click"], "Purchase").select("user_id", F.col("line").alias("event_id"))


_SECTION_SQL = """
WITH h AS (SELECT user_id, min(event_id) AS head FROM events WHERE event_type = 'purchase' GROUP BY 1),
f AS (SELECT e.user_id, min(event_id) AS first FROM events e JOIN h ON e.user_id = h.user_id AND event_id > head WHERE event_type = 'click' GROUP BY 1)
SELECT e.user_id, event_id FROM events e JOIN f ON e.user_id = f.user_id AND event_id >= first"""


def _items(spark, sf) -> DataFrame:
    """Orders as lines of words on two pages."""
    text = F.concat("l_returnflag", F.col("l_linenumber").cast("string"))
    return _t(spark, sf, "lineitem").select((F.col("l_suppkey") % 2).alias("page"), F.col("l_orderkey").alias("line"), F.floor("l_extendedprice").cast("double").alias("x0"), F.col("l_linenumber").cast("double").alias("top"), text.alias("text"))


_ITEMS_SQL = "WITH w AS (SELECT l_suppkey % 2 AS page, l_orderkey AS line, floor(l_extendedprice) AS x0, l_linenumber AS top, l_returnflag || CAST(l_linenumber AS VARCHAR) AS t FROM lineitem)"


def median_starts(spark, sf) -> DataFrame:
    """Where the columns of a page begin: medians over the lines of the commonest width."""
    starts = layout.column_starts(_items(spark, sf), ["page"])
    return starts.select("page", F.posexplode("starts").alias("place", "x_start"))


_STARTS_SQL = _ITEMS_SQL + """,
p AS (SELECT page, line, x0, row_number() OVER (PARTITION BY page, line ORDER BY x0) AS place, count(*) OVER (PARTITION BY page, line) AS n FROM w),
k AS (SELECT page, n, count(*) AS k FROM (SELECT DISTINCT page, line, n FROM p) GROUP BY ALL),
m AS (SELECT page, n AS width, k FROM k QUALIFY row_number() OVER (PARTITION BY page ORDER BY k DESC, n) = 1)
SELECT p.page, CAST(place - 1 AS INTEGER) AS place, median(x0) AS x_start FROM p JOIN m ON p.page = m.page WHERE (n = width OR k < 2) AND place <= width GROUP BY ALL"""


def fixed_width_starts(spark, sf) -> DataFrame:
    """The same from lines of exactly three words."""
    starts = layout.column_starts(_items(spark, sf), ["page"], 3)
    return starts.select("page", F.posexplode("starts").alias("place", "x_start"))


_FIXED_SQL = _ITEMS_SQL + """,
p AS (SELECT page, line, x0, row_number() OVER (PARTITION BY page, line ORDER BY x0) AS place, count(*) OVER (PARTITION BY page, line) AS n FROM w),
m AS (SELECT page, count(*) FILTER (n = 3) AS k FROM (SELECT DISTINCT page, line, n FROM p) GROUP BY ALL)
SELECT p.page, CAST(place - 1 AS INTEGER) AS place, median(x0) AS x_start FROM p JOIN m ON p.page = m.page WHERE (n = 3 OR k < 2) AND place <= 3 GROUP BY ALL"""


def entity_rows(spark, sf) -> DataFrame:
    """Lines of an x window that begin at its left and have two words or more."""
    words = layout.words_between(_items(spark, sf), 5000.0, 60000.0)
    return layout.entity_lines(words, ["page"], 30000.0, 2, 2)


_ROWS_SQL = _ITEMS_SQL + """
SELECT page, line, CAST(min(top) AS DOUBLE) AS top, CAST(count(*) AS INTEGER) AS n_words, arg_min(t, {'x': x0, 't': t}) AS first
FROM w WHERE x0 BETWEEN 5000 AND 60000 GROUP BY page, line HAVING count(*) >= 2 AND min(x0) <= 30000"""


def confident_words(spark, sf) -> DataFrame:
    """Recognised words with a sure reading."""
    words = _t(spark, sf, "events").select("event_id", F.col("value").alias("conf"), F.when(F.col("event_id") % 5 == 0, "  ").otherwise(F.col("event_type")).alias("text"))
    return layout.confident(words).select("event_id", "text")


def cleaned_cells(spark, sf) -> DataFrame:
    """Customers' orders as raw tables: line breaks, a blank first row in some, a blank first column in others."""
    number = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")) - 1
    blank = (F.col("o_custkey") % 3 == 0) & (F.col("row_no") == 0)
    first = F.when(blank | (F.col("o_custkey") % 2 == 0), "").otherwise(F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit("\n")))
    second = F.when(blank, "").otherwise(F.replace("o_orderpriority", F.lit("-"), F.lit("\n")))
    rows = _t(spark, sf, "orders").withColumn("row_no", number).select("o_custkey", "row_no", F.array(first, second).alias("cells"))
    return tables.positional(tables.cleaned_table(rows, ["o_custkey"]), ["c0", "c1", "c2"], 2)


_CELLS_SQL = """
SELECT o_custkey, CAST(r AS INTEGER) AS row_no, CASE WHEN o_custkey % 2 = 0 OR only_blank THEN p ELSE s END AS c0, CASE WHEN o_custkey % 2 <> 0 AND NOT only_blank THEN p END AS c1
FROM (SELECT o_custkey, o_orderstatus AS s, replace(o_orderpriority, '-', ' ') AS p, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS r,
  o_custkey % 3 = 0 AND count(*) OVER (PARTITION BY o_custkey) = 1 AS only_blank FROM orders) WHERE NOT (o_custkey % 3 = 0 AND r = 0)"""


def _sheet(spark, sf) -> DataFrame:
    """Customers as rows of a population sheet, with totals over areas and cells that hold no count."""
    key = F.col("c_custkey")
    return _t(spark, sf, "customer").select(
        F.concat(F.col("c_nationkey").cast("string"), F.lit(".0")).alias("DP"), F.concat(F.lit(" País  "), "c_nationkey").alias("DPNOM"), key.cast("string").alias("MPIO"), F.lit("Ｖｉｌｌａ").alias("DPMP"),
        F.lit("2024").alias("AÑO"), F.when(key % 7 == 0, "Total").when(key % 7 == 1, None).otherwise("Cabecera").alias("ÁREA GEOGRÁFICA"),
        key.cast("string").alias("Hombres 0"), F.when(key % 5 == 0, "x").otherwise(F.concat((key * 2).cast("string"), F.lit(".0"))).alias("Mujeres 100 y más"),
        key.alias("Indígena"), F.when(key % 4 != 0, key * 3).alias("Ningún grupo"))


def population_long(spark, sf) -> DataFrame:
    long = population.by_sex_and_age(_sheet(spark, sf))
    return long.select("codigo_dep", "nombre_dep", "codigo_mun", "municipio", F.col("anio").alias("year"), "sexo", "edad", "poblacion")


_LONG_SQL = """
WITH c AS (SELECT c_nationkey AS codigo_dep, 'País ' || c_nationkey AS nombre_dep, CAST(c_custkey AS VARCHAR) AS codigo_mun, 'Villa' AS municipio, 2024 AS year, c_custkey AS k FROM customer WHERE c_custkey % 7 <> 0)
SELECT * EXCLUDE k, 'HOMBRES' AS sexo, 0 AS edad, k AS poblacion FROM c UNION ALL SELECT * EXCLUDE k, 'MUJERES', 100, k * 2 FROM c WHERE k % 5 <> 0"""


def ethnic_shares(spark, sf) -> DataFrame:
    """The sheet's groups melted, summed per place, and the share that belongs to one."""
    made = population.composition(population.by_ethnic_group(_sheet(spark, sf)))
    return made.select("codigo_dep", "codigo_mun", F.col("`Indígena`").alias("indigena"), F.col("Raizal").alias("raizal"), "total", "proporcion")


_SHARES_SQL = """
SELECT c_nationkey AS codigo_dep, CAST(c_custkey AS VARCHAR) AS codigo_mun, c_custkey AS indigena, CAST(0 AS BIGINT) AS raizal, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey * 4 ELSE c_custkey END AS total,
       CASE WHEN c_custkey = 0 THEN NULL WHEN c_custkey % 4 <> 0 THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END AS proporcion
FROM customer WHERE c_custkey % 7 <> 0"""


def provider_summary(spark, sf) -> DataFrame:
    """Suppliers as a register: institutions by legal nature for each region."""
    nations = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = F.col("s_suppkey")
    nature = F.get(F.array(*map(F.lit, ("Entidad PÚBLICA", "privado", "Mixta", "otra"))), (key % 4).cast("int"))
    register = _t(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("  "), "r_name", F.lit("  uno")).alias("depa_nombre"), F.when(key % 3 == 0, "1").otherwise("2").alias("clpr_codigo"), F.when(key % 5 == 0, "Una ips").alias("clpr_nombre"), nature.alias("naju_nombre"))
    made = providers.summary(register)
    return made.toDF("region", "publica", "privada", "mixta", "total")


_PROVIDERS_SQL = """
SELECT array_to_string([upper(x[1]) || lower(x[2:]) FOR x IN string_split(r_name, ' ')], ' ') || ' Uno' AS region, count(*) FILTER (s_suppkey % 4 = 0) AS publica, count(*) FILTER (s_suppkey % 4 = 1) AS privada, count(*) FILTER (s_suppkey % 4 = 2) AS mixta, count(*) AS total
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 4 <> 3 AND (s_suppkey % 3 = 0 OR s_suppkey % 5 = 0) GROUP BY r_name"""


def score_levels(spark, sf) -> DataFrame:
    """Points of two indicators as a list with levels."""
    key = F.col("s_suppkey")
    rows = _t(spark, sf, "supplier").select("s_suppkey", (key % 6).cast("double").alias("a_pts"), F.when(key % 3 != 0, key % 5).cast("double").alias("b_pts"))
    return scorecards.score_list(rows, ["a", "b"], ["s_suppkey"])


_LEVELS_SQL = """
SELECT *, CASE points WHEN 1 THEN 'Bajo' WHEN 2 THEN 'En proceso' WHEN 3 THEN 'Satisfactorio' WHEN 4 THEN 'Optimo' ELSE 'N/D' END AS level FROM (
SELECT s_suppkey, 'a' AS indicator, CAST(s_suppkey % 6 AS DOUBLE) AS points FROM supplier
UNION ALL SELECT s_suppkey, 'b', CAST(s_suppkey % 5 AS DOUBLE) FROM supplier WHERE s_suppkey % 3 <> 0)"""

QUERIES = {f.__name__: f for f in (entity_section, median_starts, fixed_width_starts, entity_rows, confident_words, cleaned_cells, population_long, ethnic_shares, provider_summary, score_levels)}
ORACLES = {
    "entity_section": _SECTION_SQL,
    "median_starts": _STARTS_SQL,
    "fixed_width_starts": _FIXED_SQL,
    "entity_rows": _ROWS_SQL,
    "confident_words": "SELECT event_id, event_type AS text FROM events WHERE value >= 25 AND event_id % 5 <> 0",
    "cleaned_cells": _CELLS_SQL,
    "population_long": _LONG_SQL,
    "ethnic_shares": _SHARES_SQL,
    "provider_summary": _PROVIDERS_SQL,
    "score_levels": _LEVELS_SQL,
}
