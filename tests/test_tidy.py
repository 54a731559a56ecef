from pyspark.sql import functions as F

from comarca.functions import text
from comarca.operators import reshape
from comarca.plans import bulletins, geo, population, providers, scorecards

REGIONS = ["Región Uno", "Atlántico"]
CELLS = "doc string, page int, `table` int, row_no int, cells array<string>"


def test_bulletin_gate_and_fallback(spark):
    bad = [("d", 1, 0, i, ["EPS", "x", "1", "2"]) for i in range(3)]
    good = [("d", 2, 0, 0, ["Región\nUno", "Otra", "3", "1,5"]), ("d", 2, 0, 1, ["", "Otra", "3", "1,5"]), ("d", 0, 0, 0, ["Atlantico", "B", "9", "9"])]
    rows = spark.createDataFrame(bad + good, CELLS)
    got = bulletins.tidy(rows, "desnutricion_aguda", 2024, "V", REGIONS).collect()
    assert sorted((r.page, r.departamento, r.prevalencia_por_100, r.poblacion_categoria, r.anio, r.periodo_epidemiologico) for r in got) == [(2, "", "1,5", "menos_20000", 2024, "V"), (2, "Región Uno", "1,5", "menos_20000", 2024, "V")]


def test_bulletin_trim_and_missing_tables(spark):
    rows = spark.createDataFrame([("d", 3, 0, i, [c, "1"]) for i, c in enumerate(["head", "Amazonas", "Atlántico"])], CELLS)
    assert [r.entidad_territorial for r in bulletins.tidy(rows, "dengue", 2024, "I", REGIONS).collect()] == ["Amazonas", "Atlántico"]
    one = spark.createDataFrame([("d", 2, 0, 0, ["Atlántico", "1", "2", "3", "4"])], CELLS)
    assert bulletins.tidy(one, "mortalidad_materna", 2024, "I", REGIONS).count() == 1


def test_population_sheets(spark):
    rows = [
        (1, ["Proyecciones"]),
        (2, ["DP", "DPNOM", "MPIO", "DPMP", "AÑO", "ÁREA GEOGRÁFICA", None, None]),
        (3, [None, None, None, None, None, None, "Hombres 0", "Mujeres 100 y más"]),
        (4, ["5", "Región  Uno", "05001", "Villa", "2024", "Cabecera", "10", "x"]),
        (5, ["5", "Región Uno", "05001", "Villa", "2024", "Total", "10", "9"]),
    ]
    long = population.by_sex_and_age(population.named_sheet(spark.createDataFrame(rows, "row_no int, cells array<string>")))
    assert [tuple(r) for r in long.select("codigo_dep", "nombre_dep", "codigo_mun", "anio", "sexo", "edad", "poblacion").collect()] == [(5, "Región Uno", "05001", 2024, "HOMBRES", 0, 10)]
    ethnic = [(1, ["COD_DPTO", "DEPARTAMENTO", "COD_DPTO-MPIO", "MUNICIPIO", "AÑO", "Indígena", "Ningún grupo étnico-racial"]), (2, ["5", "U", "5001", "V", "2024", "3", "7"])]
    groups = population.by_ethnic_group(population.named_sheet(spark.createDataFrame(ethnic, "row_no int, cells array<string>")))
    assert sorted((r.grupo_etnico, r.poblacion) for r in groups.collect()) == [("Indígena", 3), ("Ningún grupo", 7)]
    whole = population.composition(groups).first()
    assert whole["total"] == 10 and whole["proporcion"] == 0.3 and whole["Raizal"] == 0


def test_provider_summary(spark):
    rows = [("REGIÓN  UNO", "1", "Institución", "Entidad Pública"), ("región uno", "2", "otra ips", "PRIVADO"), ("Región Uno", "2", "Profesional", "Privada"), ("B", "1", None, "Desconocida")]
    got = providers.summary(spark.createDataFrame(rows, "depa_nombre string, clpr_codigo string, clpr_nombre string, naju_nombre string"))
    assert [tuple(r) for r in got.collect()] == [("Región Uno", 1, 1, 0, 2)]


def test_scorecards(spark):
    rows = [(8, ["x", "skip"]), (9, ["1", "Barranquilla", "10", "4", None, "2"]), (10, ["2", None]), (11, ["2", "Bogotá", "a", "b"])]
    df = spark.createDataFrame(rows, "row_no int, cells array<string>")
    got = {r.entidad_territorial: r for r in scorecards.regions(df, "distrito").collect()}
    assert got["Barranquilla"].puntaje_promedio == 3.0 and got["Barranquilla"].mun_codigo_ref == 8001
    assert got["Bogotá"].puntaje_promedio is None and len(got["Bogotá"]) == 82
    scores = scorecards.score_list(scorecards.regions(df), scorecards.REGION_INDICATORS, ["nro"])
    assert sorted((r.indicator, r.level) for r in scores.collect()) == [("calidad_gaudi", "En proceso"), ("inspva", "Optimo")]
    towns = scorecards.towns(spark.createDataFrame([(10, ["1", "R", " 05", "D", "05001 ", "M", "1", "3"])], "row_no int, cells array<string>"))
    assert (towns.first().codigo_mun, towns.first().puntaje_promedio) == (5001, 3.0)


WIDE = "ＶＩＬＬＡ ﬁna"  # full-width letters and a ligature


def test_compatibility_names(spark):
    rows = [(1, ["DP", "DPNOM", "MPIO", "DPMP", "AÑO", "ÁREA GEOGRÁFICA", "Hombres 0"]), (2, ["5", "Región Uno", "05001", WIDE, "2024", "Ｔｏｔａｌ", "1"]), (3, ["5", "Región Uno", "05001", WIDE, "2024", "Cabecera", "10"]), (4, ["5", None, "05002", "Otra", "2024", None, "7"])]
    long = population.by_sex_and_age(population.named_sheet(spark.createDataFrame(rows, "row_no int, cells array<string>")))
    assert sorted((r.codigo_mun, r.nombre_dep or "", r.municipio, r.poblacion) for r in long.collect()) == [("05001", "Región Uno", "VILLA fina", 10), ("05002", "", "Otra", 7)]
    enrolled = spark.createDataFrame([("region uno", "Villa Fina")], "departamento string, municipio string")
    found = geo.conform(enrolled, geo.SOURCES["afiliacion"], geo.towns(long.where("nombre_dep IS NOT NULL"))).first()
    assert (found.geo_dep_codigo, found.geo_mun_codigo) == (5, 5001)


def test_over_distinct(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(column):
        def upper(values):
            seen.add(len(values))
            return values.map(lambda v: None if v is None or v == "é gone" else v.upper())

        return F.pandas_udf(upper, "string")(column)

    df = spark.createDataFrame([("é", None, 1), ("é", None, 2), ("plain", "plain", 3), (None, None, 4), ("é gone", "É", 5)] * 50, "`a.b` string, c string, n int")
    got = reshape.over_distinct(df, ["a.b", "c"], counted, text.beyond_ascii)
    assert got.columns == df.columns
    assert sorted(map(str, set(map(tuple, got.collect())))) == sorted(map(str, [("É", None, 1), ("É", None, 2), ("plain", "plain", 3), (None, None, 4), (None, "É", 5)])) and got.count() == 250
    seen.value = 0
    got.collect()
    assert seen.value <= 4  # two combinations, two columns
    assert reshape.over_distinct(df.limit(0), ["c"], text.compatibility_form).count() == 0
