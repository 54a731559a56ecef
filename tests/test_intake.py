"""From raw files of every kind to both wide tables, run after run."""

import io
import logging
import zipfile

import pytest
from pyspark.sql import functions as F

from comarca.operators import headed
from comarca.plans import geo, indicators, intake
from comarca.sources import delimited, manifest

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'


def workbook(rows, sheet="Hoja") -> bytes:
    def cell(r, c, v):
        ref = f"{chr(65 + c)}{r}"
        return "" if v is None else f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{ref}"><v>{v}</v></c>'

    body = "".join(f'<row r="{i}">{"".join(cell(i, j, v) for j, v in enumerate(row))}</row>' for i, row in enumerate(rows, 1))
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="{sheet}" sheetId="1" r:id="r"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {MAIN}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def zipped(data: bytes) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("leeme.txt", "x")
        z.writestr("cifras.xlsx", data)
    return out.getvalue()


IDS = ["DP", "DPNOM", "MPIO", "DPMP", "AÑO", "ÁREA GEOGRÁFICA"]
PEOPLE = [[5, "Región Uno", "05001", "Villa Ñandú", 2024, "Cabecera", 10, 20], [5, "Región Uno", "05002", "Otra", 2024, "Rural", 1, None], [5, "Región Uno", "05002", "Otra", 2024, "Total", 99, 99]]


def put(path, data: bytes) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


@pytest.fixture(scope="module")
def raw(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("intake") / "raw"
    put(root / "demografico_edad_sexo" / "p.xlsx", workbook([["Título"], IDS + [None, None], [*[None] * 6, "Hombres 0", "Mujeres 100"], *PEOPLE]))
    ethnic = [*IDS, "Indígena", "Ningún grupo étnico-racial"]
    put(root / "demografico_etnico" / "e.xlsx", workbook([ethnic, [5, "Región Uno", "05001", "Villa Ñandú", 2024, "Cabecera", 7, 3]]))
    one = [["MINISTERIO"], ["Departamento", "Municipio", "Contributivo", "Subsidiado", "Total", "Cobertura"], ["REGION UNO", "Villa Nandu", "1.000", "2", "1,002", "0.5"], [None] * 6]
    put(root / "afiliacion" / "cifras-afiliacion-salud-enero-2024.zip", zipped(workbook(one, "CoberturaMunicipio")))
    two = [["DEPARTAMENTO", "MUNICIPIO", "TOTAL AFILIADOS"], ["Región Uno", "Otra", "77"]]
    put(root / "afiliacion" / "cifras-afiliacion-oct2023.zip", zipped(workbook(two, "EPSMunicipio")))
    put(root / "irca" / "a.csv", "Anio;Mes;Codigo Dep;Codigo Mun;Promedio;Nivel de Riesgo\n2024;ABRIL;5;5001;4,5;Bajo\nx;ABRIL;5;5001;4,5;Bajo\n".encode("latin-1"))
    put(root / "irca" / "b.csv", "Anio,Mes,Codigo Dep,Codigo Mun,Promedio,Nivel de Riesgo\n2024,MAYO,5,5001,\"8,25\",Medio\n".encode("latin-1"))
    line = "Region Uno|Otra|Instituciones Prestadoras|{}\n"
    head = "depa_nombre|muni_nombre|clpr_nombre|naju_nombre\n"
    put(root / "reps_prestadores" / "reps_prestadores_2024_01.csv", (head + line.format("Pública") * 2).encode("latin-1"))
    put(root / "reps_prestadores" / "reps_prestadores_2024_02.csv", ("naju_nombre;depa_nombre;muni_nombre;clpr_nombre\nPrivada;Region Uno;Otra;Instituciones Prestadoras;x\nMixta;Region Uno;Otra\n").encode("latin-1"))
    put(root / "supersalud_ips_intervenidas" / "s_2024_01.xlsx", workbook([["Lista", None, None, None], ["Nit", "Nombre", "Tipo", None], ["1", "a", "b", "Region Uno"], ["2", "c", None, "Region Uno"]]))
    spark.createDataFrame([("Región Uno", "1.069,5", 2024, "XI")], "entidad_territorial string, incidencia_x100k string, anio int, periodo_epidemiologico string").withColumns({"dengue_total": F.lit("7"), "dengue_grave_total": F.lit("1")}).coalesce(1).write.parquet(str(root / "ins_dengue" / "d.parquet"))
    return root


def rows(spark, store, table, key):
    return {r[key]: r for r in manifest.current(spark, store, table).collect()}


def test_runs(spark, raw, caplog):
    store = str(raw.parent / "store")
    first = intake.run_intake(spark, str(raw), store, 2025)
    assert first == {"demografico_edad_sexo": 1, "demografico_etnico": 1, "irca": 2, "afiliacion": 2, "reps_prestadores": 2, "supersalud_ips_intervenidas": 1, "ins_dengue": 1}
    town, region = rows(spark, store, "metricas_municipio", "geo_mun_codigo"), rows(spark, store, "metricas_departamento", "geo_dep_codigo")
    assert set(town) == {5001, 5002} and set(region) == {5}
    assert (town[5001].pob_hombres, town[5001].pob_mujeres, town[5002].pob_total) == (10, 20, 1)
    assert (town[5001].pob_indigena, town[5001].pob_ninguno) == (7, 3)
    assert (town[5001].afiliados_total, town[5001].cobertura_pct, town[5002].afiliados_total) == (1002, 50.0, 77)
    assert (town[5001].irca_promedio, town[5001].irca_nivel_riesgo) == (8.25, "Medio")
    # of a register only the last snapshot counts; a short row is padded, so it names no institution
    assert (town[5002].ips_total, town[5002].ips_privada, town[5002].ips_publica) == (1, 1, 0)
    assert region[5].ips_intervenidas == 2 and region[5].incidencia_dengue_x100k == 1069.5

    # nothing new: nothing is read, built or switched
    before = manifest.pointer(spark, store)
    assert intake.run_intake(spark, str(raw), store, 2025) == {} and manifest.pointer(spark, store) == before

    # one new file: it alone is read, and only what stands on it is built
    put(raw / "irca" / "c.csv", b"Anio|Mes|Codigo Dep|Codigo Mun|Promedio|Nivel de Riesgo\n2024|JUNIO|5|5001|9|Alto\n")
    assert intake.run_intake(spark, str(raw), store, 2025) == {"irca": 1}
    after = manifest.pointer(spark, store)
    assert {t for t in after if after[t] != before.get(t)} == {"conformed_irca", "metricas", "metricas_municipio", "metricas_departamento"}
    assert rows(spark, store, "metricas_municipio", "geo_mun_codigo")[5001].irca_nivel_riesgo == "Alto"

    # a file in a new state takes the place of its old rows
    put(raw / "irca" / "c.csv", b"Anio|Mes|Codigo Dep|Codigo Mun|Promedio|Nivel de Riesgo\n2024|JULIO|5|5001|2,5|Sin riesgo\n")
    assert intake.run_intake(spark, str(raw), store, 2025) == {"irca": 1}
    water = manifest.current(spark, store, "conformed_irca")
    assert sorted(r.mes for r in water.collect()) == ["ABRIL", "JULIO", "MAYO"]

    # a source that fails keeps its last version; the others go on
    put(raw / "irca" / "d.csv", b"no table at all\n")
    put(raw / "supersalud_ips_intervenidas" / "s_2024_02.xlsx", workbook([["Nit", "Nombre", "Tipo", None], ["1", "aa", "bb", "Region Uno"]]))
    with caplog.at_level(logging.ERROR):
        assert intake.run_intake(spark, str(raw), store, 2025) == {"supersalud_ips_intervenidas": 1}
    assert "step failed: irca" in caplog.text
    region = rows(spark, store, "metricas_departamento", "geo_dep_codigo")[5]
    assert region.ips_intervenidas == 1 and region.irca_promedio == 2.5

    # a run that died before its pointer is not seen, and its number is not used again
    manifest.switch(spark, store, 90, {})
    next((raw.parent / "store" / "pointer" / "run=90").glob("_SUCCESS")).unlink()
    assert manifest.pointer(spark, store)["metricas_municipio"].version < 90 and manifest.next_run(spark, store) == 91


def test_modes(spark, raw, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(intake, "run_intake", lambda spark, raw, store, as_of, sources: seen.append(set(sources)) or {})
    for mode in ("monthly", "annual", "all"):
        intake.main([mode, "r", "s", "--as-of", "2024"])
    assert seen[0] | seen[1] == seen[2] == set(geo.SOURCES) and not seen[0] & seen[1]


def test_without_population(spark, tmp_path, caplog):
    put(tmp_path / "raw" / "irca" / "a.csv", b"Anio;Mes;Codigo Dep;Codigo Mun;Promedio;Nivel de Riesgo\n2024;ABRIL;5;5001;4,5;Bajo\n")
    with caplog.at_level(logging.WARNING):
        assert intake.run_intake(spark, str(tmp_path / "raw"), str(tmp_path / "store"), 2025) == {"irca": 1}
    assert "no towns" in caplog.text and manifest.pointer(spark, str(tmp_path / "store")) == {}


def test_lost_column_costs_its_group_only(spark, caplog):
    dim = spark.createDataFrame([(5, 5001, "Uno", "Otra")], "dep_codigo int, mun_codigo int, dep_dane string, mun_dane string")
    frames = {"reps_capacidad": spark.createDataFrame([(5, 5001, "x")], "geo_dep_codigo int, geo_mun_codigo int, otra string")}
    with caplog.at_level(logging.ERROR):
        row = indicators.wide(frames, dim, "town", lenient=True).first()
    assert row.capacidad_instalada is None and row.municipio == "Otra" and "reps_capacidad" in caplog.text


def test_headers_of_many_tables(spark):
    tables = {"a": [[None, "t"], ["x", "x", "long name"], ["1", "2", "3"]], "b": [["long name", "y"], ["9"], ["8", "7", "6"]]}
    df = spark.createDataFrame([(t, i, r) for t, rs in tables.items() for i, r in enumerate(rs)], "t string, row_no int, cells array<string>")
    heads = headed.headers(df, ["t"], headed.filled(2, longer_than=0), within=5)
    got = headed.by_name(df, heads, ["t"])
    assert set(got.columns) == {"t", "row_no", "x", "x.1", "long name", "y", "col_2"}
    assert sorted(map(str, (tuple(r) for r in got.select("t", "x", "`x.1`", "`long name`", "y").collect()))) == sorted(map(str, [("a", "1", "2", "3", None), ("b", None, None, "9", None), ("b", None, None, "8", "7")]))
    assert headed.headers(df, ["t"], headed.holds_any(["Y"]), needed=True).select("t").collect() == [("b",)]


def test_tolerant_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿k|v|k\n1|2|3|4\n5\n".encode())
    (tmp_path / "b.csv").write_bytes(b"v;w\nq;r\n")
    got = delimited.read_tolerant_files(spark, str(tmp_path), "UTF-8")
    assert sorted(map(str, (tuple(r) for r in got.select("k", "`k.1`", "v", "w").collect()))) == sorted(map(str, [("1", "3|4", "2", None), ("5", "", "", None), (None, None, "q", "r")]))
