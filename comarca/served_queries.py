"""Registered queries of composed plans: conformed sources to wide tables and served answers.

The sources are made of the driver's tables in the form in which they are
published: untidy place names, months and periods by name, numbers as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.functions import periods
from comarca.plans import batch, geo, indicators, serving

AS_OF = 1999


def _t(spark, sf, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _named(names: list[str], number: str):
    return F.get(F.array(*map(F.lit, names)), F.col(number) - 1)


def _sources(spark, sf) -> tuple[dict[str, DataFrame], DataFrame]:
    """(sources, towns): nations as towns, regions as regions; orders by month as what is published of them."""
    nations = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    places = nations.select(
        F.col("n_nationkey").alias("town"), F.col("n_regionkey").alias("dep"), F.concat(F.lit(" "), F.lower("r_name")).alias("dep_text"), F.concat(F.replace("n_name", F.lit("_"), F.lit(" - ")), F.lit(".")).alias("town_text"))
    dim = geo.towns(nations.select(F.col("r_regionkey").alias("codigo_dep"), F.col("r_name").alias("nombre_dep"), F.col("n_nationkey").cast("string").alias("codigo_mun"), F.replace("n_name", F.lit("_"), F.lit(" ")).alias("municipio")))
    sold = _t(spark, sf, "orders").join(_t(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).join(places, F.col("c_nationkey") == F.col("town"))
    sold = sold.withColumns({"anio": F.year("o_orderdate"), "m": F.month("o_orderdate")})
    figures = [F.sum("o_custkey").alias("c"), F.sum("o_orderkey").alias("s"), F.count(F.lit(1)).alias("n"), F.max(F.col("o_orderkey") % 97).alias("w")]
    monthly = sold.groupBy("town", "dep", "dep_text", "town_text", "anio", "m").agg(*figures)
    regional = sold.groupBy("dep_text", "anio", "m").agg(*figures).withColumns({"period": _named(periods.ROMAN, "m"), "town_text": F.lit(None).cast("string")})
    month, codes = _named(periods.MONTHS, "m"), [F.col("dep").alias("codigo_dep"), F.col("town").cast("string").alias("codigo_mun"), "anio"]
    people = monthly.select(*codes, F.explode(F.array(F.struct(F.lit("HOMBRES").alias("sexo"), F.col("c").alias("poblacion")), F.struct(F.lit("MUJERES").alias("sexo"), F.col("s").alias("poblacion")))).alias("p")).select("codigo_dep", "codigo_mun", "anio", "p.*")
    groups = F.when(F.col("c_mktsegment") == "BUILDING", "Indígena").when(F.col("c_mktsegment") == "MACHINERY", "Raizal").when(F.col("c_mktsegment") == "HOUSEHOLD", "Negra, mulata o afrocolombiana").otherwise("Ningún grupo")
    ethnic = _t(spark, sf, "customer").join(places, F.col("c_nationkey") == F.col("town")).withColumn("anio", (2000 + F.col("c_custkey") % 3).cast("int")).select(*codes, groups.alias("grupo_etnico"), F.col("c_custkey").alias("poblacion"))
    named = [F.col("dep_text").alias("departamento"), F.col("town_text").alias("municipio"), "anio"]
    enrolled = monthly.select(*named, month.alias("mes"), F.col("c").alias("afiliados_contributivo"), F.col("s").alias("afiliados_subsidiado"), (F.col("c") + F.col("s")).alias("afiliados_total"), ((F.col("s") % 4) / 4).cast("string").alias("Cobertura"))
    water = monthly.select(*codes, F.concat(F.lower(month), F.lit(" ")).alias("mes"), F.col("w").cast("double").alias("promedio_irca"), F.when(F.col("w") >= 90, "Alto").otherwise("Bajo").alias("nivel_riesgo"))
    rate = F.concat(F.col("n").cast("string"), F.lit(",5"))
    maternal = [df.select(F.lit(None).cast("string").alias("entidad_territorial"), *named, p.alias("periodo_epidemiologico"), rate.alias("razon_mm_actual")) for df, p in ((monthly, _named(periods.ROMAN, "m")), (regional, F.col("period")))]
    reported = regional.select(F.col("dep_text").alias("entidad_territorial"), "anio", F.col("period").alias("periodo_epidemiologico"), "m", "n", "w")
    register = _t(spark, sf, "supplier").join(places, F.col("s_nationkey") == F.col("town")).select("s_suppkey", F.col("dep_text").alias("depa_nombre"), F.col("town_text").alias("muni_nombre"))
    nature = F.get(F.array(*map(F.lit, ("Pública", "Privada", "Mixta"))), F.col("s_suppkey") % 4)
    sources = {
        "demografico_edad_sexo": people,
        "demografico_etnico": ethnic,
        "afiliacion": enrolled,
        "irca": water,
        "ins_mortalidad_materna": maternal[0].unionByName(maternal[1]),
        "ins_sifilis_congenita": reported.select("entidad_territorial", "anio", "periodo_epidemiologico", F.when(F.col("m") % 2 == 0, F.col("n").cast("string")).otherwise("").alias("casos_sc_total")),
        "ins_dengue": reported.select("entidad_territorial", "anio", "periodo_epidemiologico", F.col("n").cast("string").alias("dengue_total"), F.lit("1").alias("dengue_grave_total"), F.concat(F.col("w").cast("string"), F.lit(",25")).alias("incidencia_x100k")),
        "reps_prestadores": register.select("depa_nombre", "muni_nombre", F.when(F.col("s_suppkey") % 3 != 0, "Instituciones Prestadoras de Salud").otherwise("Profesional").alias("clpr_nombre"), nature.alias("naju_nombre"), F.concat(F.lit(serving.STAMP_PREFIX), F.lpad((F.col("s_suppkey") % 28 + 1).cast("string"), 2, "0")).alias("fecha_corte_reps")),
        "reps_capacidad": register.select("depa_nombre", "muni_nombre", F.when(F.col("s_suppkey") % 5 == 0, "x").otherwise(F.col("s_suppkey").cast("string")).alias("cantidad")),
        "supersalud_ips_intervenidas": register.where("s_suppkey % 2 = 0").select(F.col("depa_nombre").alias("col_3")),
    }
    return sources, dim


def _frames(spark, sf, *names: str) -> tuple[dict[str, DataFrame], DataFrame]:
    sources, dim = _sources(spark, sf)
    return batch.conformed({n: f for n, f in sources.items() if not names or n in names}, dim), dim


_MONTHS = "['ENERO','FEBRERO','MARZO','ABRIL','MAYO','JUNIO','JULIO','AGOSTO','SEPTIEMBRE','OCTUBRE','NOVIEMBRE','DICIEMBRE']"
_ROMAN = "['I','II','III','IV','V','VI','VII','VIII','IX','X','XI','XII']"
_BASE = """
WITH pl AS (SELECT n_nationkey AS town, n_regionkey AS dep, r_name, replace(n_name, '_', ' ') AS n_name FROM nation JOIN region ON n_regionkey = r_regionkey),
sold AS (SELECT dep, town, year(o_orderdate) AS anio, month(o_orderdate) AS m, o_custkey AS c, o_orderkey AS s FROM orders JOIN customer ON o_custkey = c_custkey JOIN pl ON c_nationkey = town),
om AS (SELECT dep, town, anio, m, sum(c) AS c, sum(s) AS s, count(*) AS n, max(s % 97) AS w FROM sold GROUP BY ALL),
rm AS (SELECT dep, anio, m, count(*) AS n, max(s % 97) AS w FROM sold GROUP BY ALL),
sup AS (SELECT s_suppkey, dep, town FROM supplier JOIN pl ON s_nationkey = town)"""
#: Latest month of a town and the two levels of places, for rows that a test lets in.
_LEVELS = "(SELECT 'town' AS level, dep, town FROM pl UNION SELECT 'region', dep, NULL FROM pl)"


def _latest_sql(where: str = "TRUE") -> str:
    return f"""lt AS (SELECT dep, town, arg_max(c, anio * 100 + m) AS c, arg_max(s, anio * 100 + m) AS s, arg_max(n, anio * 100 + m) AS n, arg_max(w, anio * 100 + m) AS w FROM om WHERE {where} GROUP BY ALL),
af AS (SELECT dep, town, sum(c)::BIGINT AS c, sum(s)::BIGINT AS s, sum(c + s)::BIGINT AS t, avg((s % 4) * 25.0) AS pct, avg(w)::DOUBLE AS irca, max(w) AS w, max(n) AS n FROM lt GROUP BY GROUPING SETS ((dep, town), (dep)))"""


def wide_both_grains(spark, sf) -> DataFrame:
    """Every source read once, both wide tables."""
    frames, dim = _frames(spark, sf)
    made = indicators.wide_both(frames, dim, indicators.Span(AS_OF))
    kept = ["pob_hombres", "pob_mujeres", "pob_total", "pob_etnico_total", "pob_indigena", "pob_raizal", "pob_negra_afro", "pob_ninguno", "ips_total", "ips_publica", "ips_privada", "ips_mixta", "capacidad_instalada", "ips_intervenidas",
            "afiliados_subsidiado", "afiliados_contributivo", "afiliados_total", "cobertura_pct", "irca_promedio", "irca_nivel_riesgo", "razon_mortalidad_materna", "casos_sifilis_congenita", "dengue_total", "incidencia_dengue_x100k", "tasa_intento_suicidio"]
    return made.select("level", "geo_dep_codigo", "geo_mun_codigo", "departamento", "municipio", *kept)


_WIDE_SQL = _BASE + ",\n" + _latest_sql() + f""",
po AS (SELECT dep, town, sum(c)::BIGINT AS h, sum(s)::BIGINT AS f FROM om WHERE anio = {AS_OF} GROUP BY GROUPING SETS ((dep, town), (dep))),
et AS (SELECT dep, town, sum(c_custkey)::BIGINT AS a, sum(CASE WHEN c_mktsegment = 'BUILDING' THEN c_custkey ELSE 0 END)::BIGINT AS i, sum(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_custkey ELSE 0 END)::BIGINT AS r,
  sum(CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN c_custkey ELSE 0 END)::BIGINT AS g, sum(CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') THEN c_custkey ELSE 0 END)::BIGINT AS o
  FROM customer JOIN pl ON c_nationkey = town WHERE c_custkey % 3 = 2 GROUP BY GROUPING SETS ((dep, town), (dep))),
ip AS (SELECT dep, town, count(*) AS t, count(*) FILTER (s_suppkey % 4 = 0) AS p, count(*) FILTER (s_suppkey % 4 = 1) AS v, count(*) FILTER (s_suppkey % 4 = 2) AS x FROM sup WHERE s_suppkey % 3 <> 0 GROUP BY GROUPING SETS ((dep, town), (dep))),
ca AS (SELECT dep, town, sum(CASE WHEN s_suppkey % 5 <> 0 THEN s_suppkey END)::DOUBLE AS b FROM sup GROUP BY GROUPING SETS ((dep, town), (dep))),
su AS (SELECT dep, count(*) AS k FROM sup WHERE s_suppkey % 2 = 0 GROUP BY dep),
lr AS (SELECT dep, arg_max(n, anio * 100 + m) AS n, arg_max(w, anio * 100 + m) AS w, arg_max(n, anio * 100 + m) FILTER (m % 2 = 0) AS sc FROM rm GROUP BY dep)
SELECT l.level, l.dep AS geo_dep_codigo, l.town AS geo_mun_codigo, r.r_name AS departamento, p.n_name AS municipio,
  po.h AS pob_hombres, po.f AS pob_mujeres, po.h + po.f AS pob_total, et.a AS pob_etnico_total, et.i AS pob_indigena, et.r AS pob_raizal, et.g AS pob_negra_afro, et.o AS pob_ninguno,
  ip.t AS ips_total, ip.p AS ips_publica, ip.v AS ips_privada, ip.x AS ips_mixta, ca.b AS capacidad_instalada, CASE WHEN l.level = 'region' THEN su.k END AS ips_intervenidas,
  af.s AS afiliados_subsidiado, af.c AS afiliados_contributivo, af.t AS afiliados_total, af.pct AS cobertura_pct, af.irca AS irca_promedio,
  CASE WHEN l.level = 'town' THEN CASE WHEN af.w >= 90 THEN 'Alto' ELSE 'Bajo' END END AS irca_nivel_riesgo,
  CASE WHEN l.level = 'town' THEN af.n ELSE lr.n END + 0.5::DOUBLE AS razon_mortalidad_materna,
  CASE WHEN l.level = 'region' THEN lr.sc END AS casos_sifilis_congenita, CASE WHEN l.level = 'region' THEN lr.n::DOUBLE END AS dengue_total,
  CASE WHEN l.level = 'region' THEN lr.w + 0.25::DOUBLE END AS incidencia_dengue_x100k, NULL::DOUBLE AS tasa_intento_suicidio
FROM {_LEVELS} l JOIN (SELECT DISTINCT dep, r_name FROM pl) r ON l.dep = r.dep LEFT JOIN pl p ON l.town = p.town
LEFT JOIN po ON l.dep = po.dep AND l.town IS NOT DISTINCT FROM po.town LEFT JOIN et ON l.dep = et.dep AND l.town IS NOT DISTINCT FROM et.town
LEFT JOIN ip ON l.dep = ip.dep AND l.town IS NOT DISTINCT FROM ip.town LEFT JOIN ca ON l.dep = ca.dep AND l.town IS NOT DISTINCT FROM ca.town
LEFT JOIN af ON l.dep = af.dep AND l.town IS NOT DISTINCT FROM af.town LEFT JOIN su ON l.dep = su.dep LEFT JOIN lr ON l.dep = lr.dep"""

_SERVED = ("afiliacion", "irca", "ins_mortalidad_materna", "ins_sifilis_congenita", "demografico_edad_sexo", "reps_prestadores")


def served_regions(spark, sf) -> DataFrame:
    """All regions, May 1997 over the latest figures."""
    frames, dim = _frames(spark, sf, *_SERVED)
    out = serving.region_metrics(frames, dim, AS_OF, 1997, "MAYO")
    return out.select("departamento", "dep_str", "pob_total", "afiliados_total", "cobertura_pct", "irca_promedio", "razon_mortalidad_materna", "casos_sifilis_congenita", "ips_total")


_REGIONS_SQL = _BASE + ",\n" + _latest_sql("anio = 1997 AND m = 5") + """,
po AS (SELECT dep, sum(c + s)::BIGINT AS t FROM om WHERE anio = 1997 GROUP BY dep),
ip AS (SELECT dep, count(*) AS t FROM sup WHERE s_suppkey % 3 <> 0 GROUP BY dep),
lr AS (SELECT dep, arg_max(n, m) AS n, arg_max(n, m) FILTER (m % 2 = 0) AS sc FROM rm WHERE anio = 1997 GROUP BY dep)
SELECT r_name AS departamento, lpad(CAST(r.dep AS VARCHAR), 2, '0') AS dep_str, po.t AS pob_total, af.t AS afiliados_total, af.pct AS cobertura_pct, af.irca AS irca_promedio,
  lr.n + 0.5::DOUBLE AS razon_mortalidad_materna, lr.sc AS casos_sifilis_congenita, ip.t AS ips_total
FROM (SELECT DISTINCT dep, r_name FROM pl) r LEFT JOIN po ON r.dep = po.dep LEFT JOIN ip ON r.dep = ip.dep LEFT JOIN lr ON r.dep = lr.dep LEFT JOIN af ON r.dep = af.dep AND af.town IS NULL"""


def served_towns(spark, sf) -> DataFrame:
    """Towns of a region, 1998 over the latest figures; population is not overlaid for towns."""
    frames, dim = _frames(spark, sf, *_SERVED)
    out = serving.town_metrics(frames, dim, AS_OF, 1, 1998)
    return out.select("geo_mun_codigo", "municipio", "pob_total", "afiliados_total", "cobertura_pct", "irca_nivel_riesgo", "razon_mortalidad_materna", "ips_total")


_TOWNS_SQL = _BASE + ",\n" + _latest_sql("anio = 1998") + f""",
po AS (SELECT town, sum(c + s)::BIGINT AS t FROM om WHERE anio = {AS_OF} GROUP BY town), ip AS (SELECT town, count(*) AS t FROM sup WHERE s_suppkey % 3 <> 0 GROUP BY town)
SELECT pl.town AS geo_mun_codigo, n_name AS municipio, po.t AS pob_total, af.t AS afiliados_total, af.pct AS cobertura_pct, CASE WHEN af.w >= 90 THEN 'Alto' WHEN af.w IS NOT NULL THEN 'Bajo' END AS irca_nivel_riesgo,
  af.n + 0.5::DOUBLE AS razon_mortalidad_materna, ip.t AS ips_total
FROM pl LEFT JOIN po ON pl.town = po.town LEFT JOIN ip ON pl.town = ip.town LEFT JOIN af ON pl.town = af.town WHERE pl.dep = 1"""


def served_months(spark, sf) -> DataFrame:
    """Months of 2001 that enrolment has."""
    frames, _ = _frames(spark, sf, "afiliacion")
    return serving.available_months(frames, 2001)


_MONTHS_SQL = f"SELECT DISTINCT ({_MONTHS})[month(o_orderdate)] AS month FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) = 2001"


def served_periods(spark, sf) -> DataFrame:
    """Label of the last period of every source."""
    frames, _ = _frames(spark, sf)
    return serving.source_periods(spark, frames, AS_OF)


_PERIODS_SQL = _BASE + f""",
last AS (SELECT anio, max(m) AS m FROM om WHERE anio = (SELECT max(anio) FROM om) GROUP BY anio),
even AS (SELECT ({_ROMAN})[m] || '/' || anio AS p FROM last),
mon AS (SELECT upper(substr(n, 1, 1)) || lower(substr(n, 2)) || ' ' || anio AS p FROM (SELECT ({_MONTHS})[m] AS n, anio FROM last))
SELECT 'afiliacion' AS source, p AS period FROM mon UNION ALL SELECT 'irca', p FROM mon
UNION ALL SELECT x, 'Período ' || p FROM even, (VALUES ('mortalidad_materna'), ('sifilis_congenita'), ('dengue')) v(x)
UNION ALL SELECT x, 'N/D' FROM (VALUES ('desnutricion_aguda'), ('mortalidad_menores5'), ('intento_suicidio'), ('violencia_genero')) v(x)
UNION ALL SELECT 'demografia', CAST(max(anio) AS VARCHAR) FROM om WHERE anio <= {AS_OF}
UNION ALL SELECT 'reps', lpad(CAST(max(s_suppkey % 28 + 1) AS VARCHAR), 2, '0') FROM sup"""


def served_scorecards(spark, sf) -> DataFrame:
    """A town with a scorecard of its own, and one that takes its region's."""
    _, dim = _sources(spark, sf)
    nations = _t(spark, sf, "nation").join(_t(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = _t(spark, sf, "supplier").join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    kind = F.when(F.col("s_suppkey") % 2 == 0, "departamento").otherwise("distrito")
    regional = rows.select(F.col("s_suppkey").cast("string").alias("nro"), F.lower("r_name").alias("entidad_territorial"), (F.col("s_suppkey") / 4).alias("puntaje_promedio"), kind.alias("tipo"), F.lit(None).cast("int").alias("mun_codigo_ref"))
    own = _t(spark, sf, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_regionkey").alias("codigo_dep"), F.col("n_nationkey").alias("codigo_mun"), F.col("n_name").alias("municipio")).agg((F.max("c_custkey") / 4).alias("puntaje_promedio"))
    frames = batch.conformed({"dift18_departamento": regional, "dift18_municipio": own}, dim)
    return serving.scorecard(frames, 7, 2).unionByName(serving.scorecard(frames, 99, 2))


_SCORECARDS_SQL = _BASE + """
SELECT 'town' AS kind, n.n_name AS name, max(c_custkey) / 4.0::DOUBLE AS score FROM customer JOIN nation n ON c_nationkey = n.n_nationkey WHERE n.n_nationkey = 7 GROUP BY n.n_name
UNION ALL SELECT 'region', lower(r_name), s_suppkey / 4.0::DOUBLE FROM (SELECT s_suppkey FROM sup WHERE dep = 2 ORDER BY s_suppkey % 2, CAST(s_suppkey AS VARCHAR) LIMIT 1), region WHERE r_regionkey = 2"""

QUERIES = {f.__name__: f for f in (wide_both_grains, served_regions, served_towns, served_months, served_periods, served_scorecards)}
ORACLES = {"wide_both_grains": _WIDE_SQL, "served_regions": _REGIONS_SQL, "served_towns": _TOWNS_SQL, "served_months": _MONTHS_SQL, "served_periods": _PERIODS_SQL, "served_scorecards": _SCORECARDS_SQL}
