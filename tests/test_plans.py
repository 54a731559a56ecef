import pytest
from pyspark.sql import functions as F

from comarca.plans import batch, geo, indicators, serving

PLACES = [(5, "Región Uno", "05001", "Villa Ñandú"), (5, "Región Uno", "5002.0", "Otra"), (8, "Atlántico", "08001", "Barranquilla"), (11, "Bogotá, D.C.", "11001", "Bogotá")]


@pytest.fixture(scope="module")
def sources(spark):
    people = [(d, dn, m, mn, y, s, p) for d, dn, m, mn in PLACES for y, s, p in ((2024, "HOMBRES", 10), (2024, "MUJERES", 20), (2030, "HOMBRES", 99))]
    frame = spark.createDataFrame
    return {
        "demografico_edad_sexo": frame(people, "codigo_dep int, nombre_dep string, codigo_mun string, municipio string, anio int, sexo string, poblacion long"),
        "demografico_etnico": frame([(5, "05001", 2030, "Indígena", 7), (5, "05001", 2030, "Ningún grupo", 3), (5, "05001", 2020, "Indigena", 1)], "codigo_dep int, codigo_mun string, anio int, grupo_etnico string, poblacion long"),
        "afiliacion": frame([("REGION UNO", "Villa Nandu", 1, 2, 3, "0.5", 2024, "ENERO"), ("Región Uno", "VILLA-ÑANDÚ", 10, 20, 30, "0.9", 2024, "MARZO"), ("Región Uno", "Otra", 5, 5, 10, "0.7", 2023, "MAYO"), (None, None, 1, 1, 1, None, 2024, "MAYO"), ("Región Uno", "No existe", 9, 9, 9, "1", 2024, "MAYO")], "departamento string, municipio string, afiliados_contributivo long, afiliados_subsidiado long, afiliados_total long, Cobertura string, anio int, mes string"),
        "irca": frame([(5, "5001", 2024, "ABRIL", 4.0, "Bajo"), (5, "5001", 2024, "mayo ", 8.0, "Medio")], "codigo_dep int, codigo_mun string, anio int, mes string, promedio_irca double, nivel_riesgo string"),
        "reps_prestadores": frame([("REGIÓN-UNO", "Otra", "Instituciones Prestadoras de Salud", "Pública", "Fecha corte REPS: Abr 1"), ("Region Uno", "Otra", "instituciones prestadoras - IPS", "Privada", "Fecha corte REPS: Mar 2"), ("Region Uno", "Otra", "Profesional", "Privada", None)], "depa_nombre string, muni_nombre string, clpr_nombre string, naju_nombre string, fecha_corte_reps string"),
        "ins_mortalidad_materna": frame([("Región Uno", None, None, "45,5", 2024, "II"), ("Región Uno", None, None, "40,0", 2024, "X"), (None, "Región Uno", "Otra", "1.069,0", 2024, "XI")], "entidad_territorial string, departamento string, municipio string, razon_mm_actual string, anio int, periodo_epidemiologico string"),
        "ins_sifilis_congenita": frame([("Barranquilla", "12", 2024, "V"), ("Atlántico", "7", 2024, "V"), ("Atlántico", "", 2025, "I")], "entidad_territorial string, casos_sc_total string, anio int, periodo_epidemiologico string"),
        "dift18_departamento": frame([("1", "Barranquilla", 2.0, "distrito", 8001), ("2", "Atlántico", 3.0, "departamento", None)], "nro string, entidad_territorial string, puntaje_promedio double, tipo string, mun_codigo_ref int"),
        "dift18_municipio": frame([(5, 5002, "Otra", 1.5)], "codigo_dep int, codigo_mun int, municipio string, puntaje_promedio double"),
    }


@pytest.fixture(scope="module")
def world(sources):
    dim = geo.towns(sources["demografico_edad_sexo"]).cache()
    return dim, batch.conformed(sources, dim)


def test_dimension_is_unique(world, spark):
    dim, _ = world
    assert dim.count() == 4 and dim.select("dep_codigo", "mun_codigo").distinct().count() == 4
    doubled = geo.towns(spark.createDataFrame([(5, "A", "1", "x"), (5, "B", "01", "y")], "codigo_dep int, nombre_dep string, codigo_mun string, municipio string"))
    assert [tuple(r) for r in doubled.collect()] == [(5, 1, "A", "x")]


def test_names_conform_without_loss(world, sources):
    _, frames = world
    got = frames["afiliacion"]
    assert got.count() == sources["afiliacion"].count()
    assert sorted((r.municipio, r.geo_dep_codigo, r.geo_mun_codigo) for r in got.collect() if r.municipio) == [("No existe", 5, None), ("Otra", 5, 5002), ("VILLA-ÑANDÚ", 5, 5001), ("Villa Nandu", 5, 5001)]
    assert {r.geo_dep_codigo for r in frames["ins_sifilis_congenita"].collect()} == {8}
    assert {r.geo_dep_codigo for r in frames["ins_mortalidad_materna"].collect()} == {5}


def test_aliases_on_towns(world, spark):
    dim, _ = world
    named = spark.createDataFrame([("Atlántico", "Barranquilla")], "departamento string, municipio string")
    place = geo.SOURCES["afiliacion"]
    for compat in (True, False):
        assert geo.conform(named, place, dim, compat).first().geo_mun_codigo == 8001


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_towns(world):
    dim, frames = world
    out = indicators.wide(frames, dim, "town", indicators.Span(as_of=2025))
    assert len(out.columns) == 46 and out.count() == 4
    rows = by(out, "geo_mun_codigo")
    one = rows[5001]
    assert (one["pob_hombres"], one["pob_mujeres"], one["pob_total"]) == (10, 20, 30)
    assert (one["pob_etnico_total"], one["pob_indigena"], one["pob_ninguno"]) == (10, 7, 3)
    assert (one["afiliados_total"], one["cobertura_pct"]) == (30, 90.0)
    assert (one["irca_promedio"], one["irca_nivel_riesgo"]) == (8.0, "Medio")
    assert rows[5002]["ips_total"] == 2 and rows[5002]["ips_publica"] == 1 and rows[5002]["razon_mortalidad_materna"] == 1069.0
    assert one["dengue_total"] is None and one["ips_intervenidas"] is None


def test_regions(world):
    dim, frames = world
    out = indicators.wide(frames, dim, "region", indicators.Span(as_of=2025))
    assert len(out.columns) == 45 and out.count() == 3
    rows = by(out, "geo_dep_codigo")
    assert rows[5]["pob_total"] == 60 and rows[5]["afiliados_total"] == 40 and abs(rows[5]["cobertura_pct"] - 80) < 1e-9
    assert rows[5]["razon_mortalidad_materna"] == 40.0
    assert rows[8]["casos_sifilis_congenita"] == 7  # complete rows first, then the region's own name before its district
    assert rows[11]["pob_total"] == 30 and rows[11]["ips_total"] is None


def test_both_grains_from_one_reading(world, sources, spark, tmp_path):
    dim, frames = world
    for span in (indicators.Span(2025), indicators.Span(2025, 2023, "MAYO")):
        both = indicators.wide_both(frames, dim, span)
        for grain in ("town", "region"):
            one, other = indicators.wide(frames, dim, grain, span), indicators.of_grain(both, grain)
            assert one.dtypes == other.dtypes
            assert sorted(map(str, one.collect())) == sorted(map(str, other.collect())), (grain, span)
    for name, frame in frames.items():
        frame.write.parquet(str(tmp_path / name))
    dim.write.parquet(str(tmp_path / "dim"))
    stored = {n: spark.read.parquet(str(tmp_path / n)) for n in frames}
    plan = indicators.wide_both(stored, spark.read.parquet(str(tmp_path / "dim")), indicators.Span(2025))._jdf.queryExecution().optimizedPlan().toString()
    used = [n for n in frames if n in {g.source for g in indicators.GROUPS}]
    assert plan.count("parquet") == len(used) + 2  # the dimension: as towns, as regions


def test_overlays(world):
    dim, frames = world
    base = by(serving.region_metrics(frames, dim, 2025), "geo_dep_codigo")
    year = by(serving.region_metrics(frames, dim, 2025, 2023), "geo_dep_codigo")
    assert year[5]["afiliados_total"] == 10 and year[8]["afiliados_total"] is None
    assert year[5]["razon_mortalidad_materna"] == base[5]["razon_mortalidad_materna"] == 40.0  # no rows that year: base stays
    month = by(serving.region_metrics(frames, dim, 2025, 2024, "ENERO"), "geo_dep_codigo")
    assert month[5]["afiliados_total"] == 3
    assert by(serving.region_metrics(frames, dim, 2025, 1990), "geo_dep_codigo") == base
    towns = by(serving.town_metrics(frames, dim, 2025, 5, 2023), "geo_mun_codigo")
    assert set(towns) == {5001, 5002} and towns[5002]["afiliados_total"] == 10 and towns[5001]["afiliados_total"] is None
    assert base[5]["dep_str"] == "05"


def test_periods(world, spark):
    _, frames = world
    assert [r.year for r in serving.available_years(frames).collect()] == [2024, 2023]
    assert [r.month for r in serving.available_months(frames, 2024).collect()] == ["ENERO", "MARZO", "MAYO"]
    labels = {r.source: r.period for r in serving.source_periods(spark, frames, 2025).collect()}
    assert labels["irca"] == "Mayo 2024" and labels["mortalidad_materna"] == "Período XI/2024" and labels["dengue"] == "N/D"
    assert labels["demografia"] == "2024" and labels["reps"] == "Mar 2"


def test_scorecards_and_report(world, spark):
    dim, frames = world
    assert serving.scorecard_region(frames, 8).first().tipo == "departamento"
    assert serving.scorecard(frames, 8001, 8).first().kind == "district"
    assert serving.scorecard(frames, 5002, 5).first().score == 1.5
    assert serving.scorecard(frames, 1, 8).first().kind == "region"
    regions, towns = serving.region_metrics(frames, dim, 2025), serving.town_metrics(frames, dim, 2025, 5)
    rows = by(serving.report(spark, regions, 5, towns.where("geo_mun_codigo = 5001")), "metric")
    assert rows["pob_total"]["region_text"] == "60" and rows["pob_total"]["town_text"] == "30" and rows["pob_total"]["national_text"] == "40"
    assert rows["dengue_total"]["town_text"] == "— *" and rows["cobertura_pct"]["town_text"] == "90.0 %"
    assert {r["town_text"] for r in by(serving.report(spark, regions, 5), "metric").values()} == {"—"}


def test_batch(sources, spark, tmp_path):
    for name, frame in sources.items():
        frame.write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    loaded = batch.load_sources(spark, str(tmp_path / "in"))
    assert set(loaded) == set(sources)
    assert batch.build(spark, loaded, str(tmp_path / "out"), 2025) == {"metricas_municipio": 4, "metricas_departamento": 3}


def test_tidy(spark):
    raw = spark.createDataFrame([("A", "1.234", None), (None, None, None)], "Departamento string, Total string, x string")
    out = batch.tidy_enrolment(raw, 2024, "MAYO")
    assert out.count() == 1 and out.first().afiliados_total == 1234 and out.first().mes == "MAYO"
    water = batch.tidy_water(spark.createDataFrame([("2024", "5,5"), ("x", "1")], "`Año` string, promedio_irca string"), {"Año": "anio"})
    assert [tuple(r) for r in water.collect()] == [(2024, 5.5)]
    scores = batch.tidy_scorecard(spark.createDataFrame([("1", "2", None, None), (None, None, None, None)], "a_res string, a_pts string, b_res string, b_pts string"), ["a", "b"])
    assert [r.puntaje_promedio for r in scores.orderBy(F.col("a_pts").desc()).collect()] == [2.0, None]
