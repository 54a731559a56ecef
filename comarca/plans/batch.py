"""Batch run: stored sources to conformed tables to stored indicator tables."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from comarca.functions.numbers import digits_bigint, first_comma_double, row_mean, to_double, to_int
from comarca.operators.reshape import renamed_if_present
from comarca.sources.files import list_files, read_union_by_name
from comarca.sources.sinks import write_counted, write_parquet

from .geo import SOURCES, conform, towns
from .indicators import Span, of_grain, wide_both

log = logging.getLogger(__name__)

#: Raw names of enrolment columns, as published over the years, and what they become.
ENROLMENT_NAMES = {
    "IdDepartamento": "codigo_dep",
    "Departamento": "departamento",
    "IdMunicipio": "codigo_mun",
    "Municipio": "municipio",
    "Contributivo": "afiliados_contributivo",
    "Subsidiado": "afiliados_subsidiado",
    "Total": "afiliados_total",
    "DEPARTAMENTO": "departamento",
    "MUNICIPIO": "municipio",
    "REGIMEN": "regimen",
    "Régimen": "regimen",
    "ENTIDAD": "entidad",
    "Entidad": "entidad",
    "AFILIADOS": "afiliados_total",
    "Afiliados": "afiliados_total",
    "TOTAL AFILIADOS": "afiliados_total",
    "Total Afiliados": "afiliados_total",
    "CODIGO DEPARTAMENTO": "codigo_dep",
    "CODIGO MUNICIPIO": "codigo_mun",
    "Código Departamento": "codigo_dep",
    "Código Municipio": "codigo_mun",
}
#: Raw names of water quality columns and what they become.
WATER_NAMES = {
    "Anio": "anio",
    "Mes": "mes",
    "Codigo Dep": "codigo_dep",
    "Nombre Dep": "nombre_dep",
    "Codigo Mun": "codigo_mun",
    "Municipio": "municipio",
    "Cantidad Muestras": "n_muestras",
    "Promedio Parametros": "promedio_parametros",
    "Promedio": "promedio_irca",
    "Nivel de Riesgo": "nivel_riesgo",
    "Cantidad Muestras Urbanas": "n_muestras_urbano",
    "Promedio Parametros Urbano": "promedio_parametros_urbano",
    "Promedio IRCA Urbano": "promedio_irca_urbano",
    "Nivel Riesgo Urbano": "nivel_riesgo_urbano",
    "Cantidad Muestras Rural": "n_muestras_rural",
    "Promedio Parametros Rural": "promedio_parametros_rural",
    "Promedio IRCA Rural": "promedio_irca_rural",
    "Nivel Riesgo Rural": "nivel_riesgo_rural",
}
ENROLMENT_COUNTS = ("afiliados_contributivo", "afiliados_subsidiado", "afiliados_total")
WATER_INTS = ("anio", "codigo_dep", "codigo_mun", "n_muestras", "n_muestras_urbano", "n_muestras_rural")
WATER_DOUBLES = ("promedio_irca", "promedio_irca_urbano", "promedio_irca_rural", "promedio_parametros", "promedio_parametros_urbano", "promedio_parametros_rural")


def merged_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns renamed; of several that become one, the first value that is there."""
    groups: dict[str, list[str]] = {}
    for c in df.columns:
        groups.setdefault(names.get(c, c), []).append(c)
    return df.select(*(F.coalesce(*(F.col(f"`{c}`") for c in cs)).alias(n) for n, cs in groups.items()))


def tidy_enrolment(raw: DataFrame, year: int | Column, month: str | Column, keep: Sequence[str] = ()) -> DataFrame:
    """Known names, whole counts, the file's period; rows with nothing beside ``keep`` go."""
    some = raw.dropna(how="all", subset=[c for c in raw.columns if c not in keep])
    named = merged_names(some, ENROLMENT_NAMES)
    counts = {c: digits_bigint(F.col(c)) for c in ENROLMENT_COUNTS if c in named.columns}
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return named.withColumns({**counts, "anio": as_column(year), "mes": as_column(month)})


def tidy_water(raw: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Known names, integers and first-comma decimals; rows without a year go."""
    named = renamed_if_present(raw, names)
    casts = {c: to_int(F.col(c)) for c in WATER_INTS if c in named.columns} | {c: first_comma_double(F.col(c)) for c in WATER_DOUBLES if c in named.columns}
    return named.withColumns(casts).where("anio IS NOT NULL")


def tidy_scorecard(raw: DataFrame, indicators: list[str]) -> DataFrame:
    """Results and points as doubles, with the mean of the points that are there."""
    casts = {f"{i}_{s}": to_double(F.col(f"{i}_{s}")) for i in indicators for s in ("res", "pts")}
    typed = raw.withColumns(casts)
    return typed.withColumn("puntaje_promedio", row_mean([F.col(f"{i}_pts") for i in indicators]))


def safely(name: str, step: Callable[[], object]) -> object | None:
    """Run a step; a failure is logged and the next step goes on."""
    try:
        return step()
    except Exception:
        log.exception("step failed: %s", name)
        return None


def load_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Every known source with files under ``folder`` (name.parquet or name_<stamp>.parquet)."""
    found = {}
    for name in SOURCES:
        pattern = f"{folder}/{name}{{,_[0-9]*,_PE_*}}.parquet"
        if not list_files(spark, pattern):
            log.warning("no files: %s", name)
            continue
        found[name] = read_union_by_name(spark, pattern)
    return found


def conformed(sources: Mapping[str, DataFrame], town_dim: DataFrame, compat: bool = True, out: str | None = None) -> dict[str, DataFrame]:
    """Every source with its region and town codes; one that fails is left out.

    With ``out`` each is written there within its own step, so a row that
    cannot be read fails that source and no other.
    """
    def step(name: str, source: DataFrame) -> DataFrame:
        made = conform(source, SOURCES[name], town_dim, compat)
        if out is None:
            return made
        write_parquet(made, f"{out}/{name}")
        return made.sparkSession.read.parquet(f"{out}/{name}")

    made = {n: safely(n, lambda n=n, s=s: step(n, s)) for n, s in sources.items()}
    return {n: f for n, f in made.items() if f is not None}


def build(spark: SparkSession, sources: Mapping[str, DataFrame], out: str, as_of: int) -> dict[str, int]:
    """Write the dimension and both wide tables; gives their row counts."""
    if "demografico_edad_sexo" not in sources:
        log.warning("no population, so no towns: nothing is built")
        return {}
    town_dim = towns(sources["demografico_edad_sexo"])
    write_parquet(town_dim, f"{out}/geo_maestro")
    town_dim = spark.read.parquet(f"{out}/geo_maestro")
    frames = conformed(sources, town_dim, out=f"{out}/conformed")
    # both grains at once, so that a conformed source is read once
    write_parquet(wide_both(frames, town_dim, Span(as_of), lenient=True), f"{out}/metricas", ["level"])
    both = spark.read.parquet(f"{out}/metricas")
    counts = {}
    for grain, name in (("town", "metricas_municipio"), ("region", "metricas_departamento")):
        counts[name] = safely(name, lambda grain=grain, name=name: write_counted(of_grain(both, grain), f"{out}/{name}"))
    return counts


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Build the indicator tables from stored sources.")
    parser.add_argument("sources")
    parser.add_argument("out")
    parser.add_argument("--as-of", type=int, default=date.today().year, help="last year of population figures")
    given = parser.parse_args(args)
    spark = SparkSession.builder.getOrCreate()
    print(build(spark, load_sources(spark, given.sources), given.out, given.as_of))


if __name__ == "__main__":
    main()
