"""Conformance of free-text place names to region codes, all in the engine.

A bridge is built from the *distinct* names of a source: keys are computed
once per spelling, looked up in the small dimension, and joined back null-safe.
``compat`` applies region aliases to municipality names too, as published
figures did; ``strict`` (compat=False) only to regions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions.numbers import to_int
from comarca.functions.text import geo_key
from comarca.operators.joins import first_per_key

#: Match keys of regions that sources spell otherwise, special
#: districts with the region they belong to included.
REGION_ALIASES = {
    "NORTE SANTANDER": "NORTE DE SANTANDER",
    "SAN ANDRES Y PROVIDENCIA": "SAN ANDRES PROVIDENCIA Y SANTA CATALINA",
    "SAN ANDRES": "SAN ANDRES PROVIDENCIA Y SANTA CATALINA",
    "ARCH SAN ANDRES": "SAN ANDRES PROVIDENCIA Y SANTA CATALINA",
    "ARC SAN ANDRES": "SAN ANDRES PROVIDENCIA Y SANTA CATALINA",
    "ARCHIPIELAGO SAN ANDRES PROVIDENCIA Y SANTA CATALINA": "SAN ANDRES PROVIDENCIA Y SANTA CATALINA",
    "BOGOTA": "BOGOTA D C",
    "D C": "BOGOTA D C",
    "BARRANQUILLA": "ATLANTICO",
    "CARTAGENA": "BOLIVAR",
    "CALI": "VALLE DEL CAUCA",
    "SANTA MARTA": "MAGDALENA",
    "SANTA MARTA D E": "MAGDALENA",
    "STA MARTA D E": "MAGDALENA",
    "BUENAVENTURA": "VALLE DEL CAUCA",
    "GUAJIRA": "LA GUAJIRA",
    "IBAGUE": "TOLIMA",
    "POPAYAN": "CAUCA",
}


@dataclass(frozen=True)
class Place:
    """How a source names places: columns, whether they hold codes, a fallback for a null region."""

    region: str
    town: str | None = None
    codes: bool = False
    fallback: str | None = None

    def region_column(self) -> Column:
        return F.coalesce(self.region, self.fallback) if self.fallback else F.col(self.region)


#: Where each source keeps its places.
SOURCES = {
    "demografico_edad_sexo": Place("codigo_dep", "codigo_mun", codes=True),
    "demografico_etnico": Place("codigo_dep", "codigo_mun", codes=True),
    "irca": Place("codigo_dep", "codigo_mun", codes=True),
    "dift18_municipio": Place("codigo_dep", "codigo_mun", codes=True),
    "afiliacion": Place("departamento", "municipio"),
    "reps_sedes": Place("departamento", "municipio"),
    **{f"reps_{s}": Place("depa_nombre", "muni_nombre") for s in ("prestadores", "servicios", "capacidad", "medidas_seguridad", "sanciones")},
    "ins_mortalidad_materna": Place("departamento", "municipio", fallback="entidad_territorial"),
    "ins_desnutricion_aguda": Place("departamento", "municipio"),
    "ins_intento_suicidio": Place("departamento", "municipio"),
    **{f"ins_{s}": Place("entidad_territorial") for s in ("sifilis_congenita", "mortalidad_menores5", "dengue", "violencia_genero")},
    **{f"supersalud_{s}_intervenidas": Place("col_3") for s in ("ips", "eps")},
    "dift18_departamento": Place("entidad_territorial"),
}


def towns(population: DataFrame) -> DataFrame:
    """(dep_codigo, mun_codigo, dep_dane, mun_dane), one row for each pair of codes.

    Spellings differ between years; the smallest of a code is kept, so no join
    to the dimension fans out.
    """
    coded = population.select(to_int(F.col("codigo_dep")).alias("dep_codigo"), to_int(F.col("codigo_mun")).alias("mun_codigo"), F.col("nombre_dep").alias("dep_dane"), F.col("municipio").alias("mun_dane"))
    named = coded.where(F.col("dep_codigo").isNotNull() & F.col("mun_codigo").isNotNull())
    return named.groupBy("dep_codigo", "mun_codigo").agg(F.min("dep_dane").alias("dep_dane"), F.min("mun_dane").alias("mun_dane"))


def regions(town_dim: DataFrame) -> DataFrame:
    """(dep_codigo, dep_dane), one row for each code."""
    return town_dim.groupBy("dep_codigo").agg(F.min("dep_dane").alias("dep_dane"))


def bridge(source: DataFrame, place: Place, town_dim: DataFrame, compat: bool = True) -> DataFrame:
    """(raw_dep, raw_mun, dep_codigo, mun_codigo) of every spelling with a region name; codes null without a match."""
    town_aliases = REGION_ALIASES if compat else None
    region_keys = first_per_key(town_dim.select(geo_key(F.col("dep_dane"), REGION_ALIASES).alias("_rk"), "dep_codigo"), ["_rk"], "dep_codigo")
    raw_town = F.col(place.town) if place.town else F.lit(None).cast("string")
    names = source.select(place.region_column().cast("string").alias("raw_dep"), raw_town.cast("string").alias("raw_mun")).distinct().where(F.col("raw_dep").isNotNull())
    coded = names.withColumn("_rk", geo_key(F.col("raw_dep"), REGION_ALIASES)).join(region_keys, "_rk", "left").drop("_rk")
    if place.town is None:
        return coded.withColumn("mun_codigo", F.lit(None).cast("int"))
    town_keys = first_per_key(town_dim.select("dep_codigo", geo_key(F.col("mun_dane"), town_aliases).alias("_tk"), "mun_codigo"), ["dep_codigo", "_tk"], "mun_codigo")
    return coded.withColumn("_tk", geo_key(F.col("raw_mun"), town_aliases)).join(town_keys, ["dep_codigo", "_tk"], "left").select("raw_dep", "raw_mun", "dep_codigo", "mun_codigo")


def conform(source: DataFrame, place: Place, town_dim: DataFrame, compat: bool = True) -> DataFrame:
    """The source with geo_dep_codigo, geo_mun_codigo, geo_dep_dane, geo_mun_dane; no row lost or doubled.

    The dimension joins carry no hint: Spark broadcasts it by its own size check.
    """
    no_town = F.lit(None)
    if place.codes:
        keyed = source.withColumns({"geo_dep_codigo": to_int(F.col(place.region)), "geo_mun_codigo": to_int(F.col(place.town)) if place.town else no_town.cast("int")})
    else:
        made = bridge(source, place, town_dim, compat)
        test = place.region_column().cast("string").eqNullSafe(made["raw_dep"])
        if place.town:
            test = test & F.col(place.town).cast("string").eqNullSafe(made["raw_mun"])
        keyed = source.join(made, test, "left").drop("raw_dep", "raw_mun").withColumnsRenamed({"dep_codigo": "geo_dep_codigo", "mun_codigo": "geo_mun_codigo"})
    if place.town:
        names = town_dim.select(F.col("dep_codigo").alias("_d"), F.col("mun_codigo").alias("_m"), F.col("dep_dane").alias("geo_dep_dane"), F.col("mun_dane").alias("geo_mun_dane"))
        return keyed.join(names, (F.col("geo_dep_codigo") == F.col("_d")) & (F.col("geo_mun_codigo") == F.col("_m")), "left").drop("_d", "_m")
    names = regions(town_dim).select(F.col("dep_codigo").alias("_d"), F.col("dep_dane").alias("geo_dep_dane"))
    return keyed.join(names, F.col("geo_dep_codigo") == F.col("_d"), "left").drop("_d").withColumn("geo_mun_dane", no_town.cast("string"))
