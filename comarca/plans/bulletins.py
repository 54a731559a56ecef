"""Epidemiological bulletins: extracted tables to one typed-by-name table per event.

Input rows have (doc string, page int, table int, row_no int, cells
array<string>): what a table extractor or :mod:`comarca.operators.layout` gave
for each page.  Measures stay text here; indicators coerce them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.functions.text import match_key
from comarca.operators import tables
from comarca.operators.aggregate import gated

TABLE = ["doc", "page", "table"]


@dataclass(frozen=True)
class Table:
    """A table on a page: its place, column names, and what its rows must satisfy."""

    page: int
    table: int
    columns: tuple[str, ...]
    gate: str | None = None
    least_rows: int = 0
    label: str | None = None
    first_entity: str | None = None
    fallback_pages: tuple[int, ...] = ()


#: Published column orders.
_MOTHERS = ("casos_mm_previo", "casos_mm_actual", "razon_mm_previo", "razon_mm_actual")
_TOWN = ("departamento", "municipio")
_HUNGER = (*_TOWN, "casos", "prevalencia_por_100")
_ENTITY = "entidad_territorial"
EVENTS: dict[str, tuple[Table, ...]] = {
    "mortalidad_materna": (
        Table(2, 0, (_ENTITY, *_MOTHERS), gate=_ENTITY),
        *(Table(2, n, (*_TOWN, *_MOTHERS)) for n in (1, 2)),
        Table(0, 3, (*_TOWN, *_MOTHERS), gate="departamento"),
    ),
    "sifilis_congenita": (Table(2, 0, (_ENTITY, "casos_sc_mf", "pct_mf", "casos_sc_nv", "pct_nv", "casos_sc_total"), gate=_ENTITY, least_rows=30, fallback_pages=(1, 3, 4)),),
    "desnutricion_aguda": tuple(Table(1, n, _HUNGER, gate="departamento", label=label, fallback_pages=(2, 0, 3)) for n, label in enumerate(("menos_20000", "entre_20000_100000", "mas_100000"))),
    "mortalidad_menores5": (Table(1, 0, (_ENTITY, "tasa_dnt", "tasa_ira", "tasa_eda")),),
    "dengue": (
        Table(3, 0, (
            _ENTITY, "dengue_total", "dengue_grave_total", "bajo_investigacion", "incidencia_x100k", "sin_alarma_n", "con_alarma_n", "grave_n",
            "sin_alarma_confirmacion_pct", "con_alarma_confirmacion_pct", "grave_confirmacion_pct", "con_alarma_hospitalizacion_pct", "grave_hospitalizacion_pct",
            "muertes_confirmadas", "letalidad_dengue_pct", "letalidad_dengue_grave_pct",
        ), first_entity="Amazonas"),
    ),
    "intento_suicidio": (Table(1, 0, (*_TOWN, "tasa"), gate="departamento", least_rows=5), Table(2, 0, (*_TOWN, "tasa"))),
    "violencia_genero": (Table(1, 0, (_ENTITY, "violencia_fisica", "violencia_psicologica", "negligencia_abandono", "violencia_sexual", "violencia_genero_intrafamiliar"), first_entity="COLOMBIA"),),
}


def _passing(rows: DataFrame, spec: Table, known: Column | None) -> DataFrame:
    """A table's rows by name, if they pass its gate; blank gate values are not counted."""
    named = tables.positional(rows, spec.columns, len(spec.columns))
    if spec.gate is None and not spec.least_rows:
        return named
    value = F.coalesce(F.trim(spec.gate or spec.columns[0]), F.lit(""))
    accepted = known if spec.gate else F.lit(True)
    return gated(named, TABLE, accepted, spec.least_rows, 0.3 if spec.gate else 0.0, value != "")


def tidy(rows: DataFrame, event: str, year: int, period: str, regions: list[str]) -> DataFrame:
    """All tables of an event in one, with ``anio``, ``periodo_epidemiologico`` and ``evento``.

    A table number that is not there gives nothing (the last table does not
    stand in for it).  Where no table of the event's page passes its gate, the
    fallback pages are tried in order, each document for itself.
    """
    keys = sorted({r.upper() for r in regions})
    clean = tables.cleaned_table(rows, TABLE)
    parts = []
    for spec in EVENTS[event]:
        known = match_key(F.col(spec.gate)).isin([_key(k) for k in keys]) if spec.gate else None
        pages = [spec.page, *spec.fallback_pages]
        order = F.element_at(F.create_map(*(F.lit(x) for i, p in enumerate(pages) for x in (p, i))), F.col("page"))
        named = _passing(clean.where(F.col("page").isin(pages) & (F.col("table") == spec.table)), spec, known)
        if len(pages) > 1:
            named = named.withColumn("_o", order).withColumn("_best", F.min("_o").over(Window.partitionBy("doc"))).where("_o = _best").drop("_o", "_best")
        if spec.first_entity:
            named = tables.from_first(named, TABLE, F.col(spec.columns[0]).startswith(spec.first_entity))
        parts.append(named.withColumn("poblacion_categoria", F.lit(spec.label)) if spec.label else named)
    whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return whole.withColumns({"anio": F.lit(year), "periodo_epidemiologico": F.lit(period), "evento": F.lit(event)})


def _key(name: str) -> str:
    import re
    import unicodedata

    plain = "".join(c for c in unicodedata.normalize("NFD", name.upper()) if unicodedata.category(c) != "Mn")
    return re.sub(r"\s+", " ", re.sub(r"[^A-Z0-9 ]", " ", plain)).strip()
