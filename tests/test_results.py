"""Stored answers: found again while their tables stay, missed and cleared once they change."""

import pytest

from comarca.plans import geo, indicators, results
from comarca.sources import manifest
from comarca.sources.manifest import Built
from comarca.sources.sinks import write_parquet


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("answers"))
    frame = spark.createDataFrame
    dim = frame([(5, 5001, "Uno", "Villa"), (5, 5002, "Uno", "Otra"), (8, 8001, "Dos", "Puerto")], "dep_codigo int, mun_codigo int, dep_dane string, mun_dane string")
    enrolled = frame([(5, 5001, 1, 2, 3, "0.5", 2023, "ENERO"), (5, 5002, 4, 5, 9, "0.7", 2024, "MAYO"), (8, 8001, 1, 1, 2, "1", 2024, "ABRIL")], "geo_dep_codigo int, geo_mun_codigo int, afiliados_contributivo long, afiliados_subsidiado long, afiliados_total long, Cobertura string, anio int, mes string")
    enrolled = enrolled.selectExpr("*", "'Uno' geo_dep_dane", "'Uno' departamento", "'x' municipio")
    write_parquet(dim, f"{root}/gold/geo_maestro/run=1")
    write_parquet(enrolled, f"{root}/gold/conformed_afiliacion/run=1")
    both = indicators.wide_both({"afiliacion": enrolled}, dim, indicators.Span(2025))
    for grain, name in (("town", "metricas_municipio"), ("region", "metricas_departamento")):
        write_parquet(indicators.of_grain(both, grain), f"{root}/gold/{name}/run=1")
    manifest.switch(spark, root, 1, {n: Built(1, "") for n in ("geo_maestro", "conformed_afiliacion", "metricas_municipio", "metricas_departamento")})
    return root


def from_results(df):
    return all("/results/" in f for f in df.inputFiles())


def test_hit_reads_the_answer_alone(spark, store, monkeypatch):
    first = results.ask(spark, store, "towns", as_of=2025, region=5, year=2024)
    assert [(r.municipio, r.afiliados_total) for r in first.collect()] == [("Otra", 9), ("Villa", None)]
    monkeypatch.setattr(results.Tables, "table", lambda *_: pytest.fail("a source was read"))
    again = results.ask(spark, store, "towns", as_of=2025, region=5, year=2024, month=None)
    assert from_results(again) and again.collect() == first.collect()


def test_every_question(spark, store):
    assert [r.year for r in results.ask(spark, store, "years").collect()] == [2024, 2023]
    assert [r.month for r in results.ask(spark, store, "months", year=2024).collect()] == ["ABRIL", "MAYO"]
    periods = {r.source: r.period for r in results.ask(spark, store, "periods", as_of=2025).collect()}
    assert periods["afiliacion"] == "Mayo 2024" and periods["irca"] == "N/D"
    assert [(r.departamento, r.afiliados_total) for r in results.ask(spark, store, "regions", as_of=2025).collect()] == [("Dos", 2), ("Uno", 12)]
    report = {r.metric: r for r in results.ask(spark, store, "report", as_of=2025, region=5, town=5002).collect()}
    assert len(report) == 36 and (report["afiliados_total"].region_text, report["afiliados_total"].town_text) == ("12", "9")
    with pytest.raises(KeyError):
        results.ask(spark, store, "scorecard", town=1, region=5)  # no scorecards in this store


def test_changed_source_misses_and_old_answers_go(spark, store):
    before = manifest.pointer(spark, store)
    old = results.ask(spark, store, "months", year=2024)
    other = results.ask(spark, store, "regions", as_of=2025).inputFiles()
    changed = spark.read.parquet(f"{store}/gold/conformed_afiliacion/run=1").where("mes <> 'ABRIL'")
    write_parquet(changed, f"{store}/gold/conformed_afiliacion/run=2")
    manifest.switch(spark, store, 2, before | {"conformed_afiliacion": Built(2, "")})
    new = results.ask(spark, store, "months", year=2024)
    assert [r.month for r in new.collect()] == ["MAYO"] and new.inputFiles() != old.inputFiles()
    assert results.expire(spark, store, [before]) == 0 and old.count() == 2
    assert results.expire(spark, store) > 0
    assert results.ask(spark, store, "months", year=2024).inputFiles() == new.inputFiles()
    assert results.ask(spark, store, "regions", as_of=2025).inputFiles() != other


def test_unrelated_change_keeps_the_answer(spark, store):
    cards = spark.createDataFrame([("1", "Uno", 2.5, "departamento", None, 5)], "nro string, entidad_territorial string, puntaje_promedio double, tipo string, mun_codigo_ref int, geo_dep_codigo int")
    towns = spark.createDataFrame([(5001, "Villa", 1.5)], "geo_mun_codigo int, municipio string, puntaje_promedio double")
    kept = results.ask(spark, store, "years").inputFiles()
    for name, df in (("dift18_departamento", cards), ("dift18_municipio", towns)):
        write_parquet(df, f"{store}/gold/conformed_{name}/run=3")
    manifest.switch(spark, store, 3, manifest.pointer(spark, store) | {f"conformed_dift18_{s}": Built(3, "") for s in ("departamento", "municipio")})
    assert results.ask(spark, store, "years").inputFiles() == kept
    assert tuple(results.ask(spark, store, "scorecard", town=5001, region=5).first()) == ("town", "Villa", 1.5)
    assert tuple(results.ask(spark, store, "scorecard", town=9, region=5).first()) == ("region", "Uno", 2.5)


def test_half_written_answer_is_not_read(spark, store, tmp_path):
    from pathlib import Path

    done = results.ask(spark, store, "months", year=2023)
    attempt = Path(done.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent
    (attempt / "_SUCCESS").unlink()
    again = results.ask(spark, store, "months", year=2023)
    assert again.inputFiles() != done.inputFiles() and [r.month for r in again.collect()] == ["ENERO"]
