"""Wide indicator tables from a registry: one row per town, one per region.

An indicator is declared once, as a rule per grain and its measures; the same
entry gives the latest, the year-restricted and the rolled-up variant.  A
source that is missing gives typed nulls and no join.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window, functions as F

from comarca.functions.numbers import locale_bigint, locale_double, to_double
from comarca.functions.periods import month_rank, period_rank
from comarca.functions.text import contains_any, geo_key
from comarca.operators.aggregate import at_maximum
from comarca.operators.joins import star
from comarca.operators.latest import complete_first, latest_per, two_level

from .geo import REGION_ALIASES, SOURCES, regions

log = logging.getLogger(__name__)
TOWN, REGION = ("geo_dep_codigo", "geo_mun_codigo"), ("geo_dep_codigo",)
Frames = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Span:
    """What part of time a plan looks at: all up to ``as_of``, or one year (and month)."""

    as_of: int | None = None
    year: int | None = None
    month: str | None = None


@dataclass(frozen=True)
class Measure:
    name: str
    kind: str
    value: Callable[[], Column]
    rollup: Callable[[Column], Column] | None = None


@dataclass(frozen=True)
class Group:
    """Measures of one source, made by ``town`` and ``region`` rules (None: typed nulls), or by ``both`` at once."""

    source: str
    measures: tuple[Measure, ...]
    town: Callable | None = None
    region: Callable | None = None
    both: Callable | None = None
    overlaid: tuple[str, ...] = ()
    hidden: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    def shown(self, grain: str) -> list[Measure]:
        return [m for m in self.measures if m.name not in self.hidden.get(grain, ())]


def _dated(df: DataFrame, span: Span, rank: str | None) -> DataFrame:
    """Rows of the span's year and month; filtered before any ranking."""
    if span.year is not None:
        df = df.where(F.col("anio") == span.year)
        if span.month and rank == "month":
            df = df.where(F.upper(F.trim("mes")) == span.month)
    return df


def _order(rank: str) -> list[Column]:
    return [F.col("anio"), month_rank(F.col("mes")) if rank == "month" else period_rank(F.col("periodo_epidemiologico"))]


def _ties(df: DataFrame, source: str) -> list[Column]:
    """Of rows equal in time: the region's own name before aliases, no town before towns, then by content."""
    place, out = SOURCES[source], []
    if not place.codes:
        out.append((geo_key(place.region_column()) == geo_key(F.col("geo_dep_dane"), REGION_ALIASES)).cast("int"))
        if place.town:
            out.append(F.col(place.town).isNull().cast("int"))
    plain = sorted(c for c, kind in df.dtypes if not kind.startswith("map"))
    return [*out, F.struct(*(F.col(f"`{c}`").cast("string") for c in plain))]


def totals(df: DataFrame, keys: tuple[str, ...], group: Group, grain: str, span: Span, years: str = "") -> DataFrame:
    """Plain aggregates; ``years``: '' all rows, 'capped' or 'last' the last year (not past as_of)."""
    if span.year is not None and years:
        df = df.where(F.col("anio") == span.year)
    elif years:
        df = at_maximum(df, "anio", F.lit(span.as_of) if years == "capped" and span.as_of is not None else None)
    df = df.where(F.col(keys[-1]).isNotNull())
    return df.groupBy(*keys).agg(*(m.value().alias(m.name) for m in group.shown(grain)))


def latest(df: DataFrame, keys: tuple[str, ...], group: Group, grain: str, span: Span, rank: str = "period", complete: str | None = None, whole_region: bool = False) -> DataFrame:
    """Latest row of each key; towns are told by their own code alone."""
    df = _dated(df, span, rank).where(F.col(keys[-1]).isNotNull())
    if whole_region:
        df = df.where(F.col("geo_mun_codigo").isNull())
    order = [*([complete_first(F.col(complete))] if complete else []), *_order(rank)]
    values = {**({"geo_dep_codigo": F.col("geo_dep_codigo")} if keys == TOWN else {}), **{m.name: m.value() for m in group.shown(grain)}}
    return latest_per(df, [keys[-1]], order, values, _ties(df, group.source))


def rolled_up(df: DataFrame, keys: tuple[str, ...], group: Group, grain: str, span: Span, rank: str = "period") -> DataFrame:
    """Latest row of each town, aggregated per region."""
    df = _dated(df, span, rank).where(F.col("geo_mun_codigo").isNotNull())
    measures = group.shown(grain)
    return two_level(df, ["geo_mun_codigo"], ["geo_dep_codigo"], _order(rank), {m.name: m.value() for m in measures}, {m.name: m.rollup(F.col(m.name)) for m in measures}, _ties(df, group.source))


#: Key columns of a frame that holds both grains; ``unit`` is the town's code, 0 for a region.
LEVEL = ("level", "geo_dep_codigo", "unit")


def _levelled(sets: DataFrame, values: Mapping[str, tuple[Column, Column]], *more: str) -> DataFrame:
    """Grouping sets of region and town as rows of LEVEL, from (town, region) values of each column."""
    is_region = F.grouping("geo_mun_codigo") == 1
    pairs = [c.alias(f"{side}_{n}") for n, cs in values.items() for side, c in zip(("t", "r"), cs)]
    made = sets.agg(is_region.alias("_region"), *pairs).where(F.col("_region") | F.col("geo_mun_codigo").isNotNull() | F.lit(bool(more)))
    pick = lambda n: F.when(F.col("_region"), F.col(f"r_{n}")).otherwise(F.col(f"t_{n}")).alias(n)
    level = F.when(F.col("_region"), "region").otherwise("town").alias("level")
    unit = F.when(F.col("_region"), 0).otherwise(F.col("geo_mun_codigo")).cast("int").alias("unit")
    return made.select(level, F.col("geo_dep_codigo").cast("int").alias("geo_dep_codigo"), unit, *more, *(pick(n) for n in values))


def _shown_on(group: Group, town: Callable[[Measure], Column], region: Callable[[Measure], Column]) -> dict[str, tuple[Column, Column]]:
    """(town, region) value of every measure, null where a grain does not show it."""
    shown = {g: {m.name for m in group.shown(g)} for g in ("town", "region")}
    none = lambda m: F.lit(None).cast(m.kind)
    return {m.name: (town(m) if m.name in shown["town"] else none(m), region(m) if m.name in shown["region"] else none(m)) for m in group.measures}


def both_totals(df: DataFrame, group: Group, span: Span, years: str = "") -> DataFrame:
    """:func:`totals` of both grains, from one reading of the source.

    The last year is found among the sums (a row for each place and year), not
    by a second reading; that window sees no row of the source.
    """
    by_year = bool(years) and span.year is None
    if years and span.year is not None:
        df = df.where(F.col("anio") == span.year)
    elif years == "capped" and span.as_of is not None:
        df = df.where(F.col("anio") <= span.as_of)
    more = ["anio"] if by_year else []
    keys = [*more, "geo_dep_codigo", "geo_mun_codigo"]
    sets = df.groupingSets([[F.col(k) for k in keys], [F.col(k) for k in keys[:-1]]], *(F.col(k) for k in keys))
    made = _levelled(sets, _shown_on(group, lambda m: m.value(), lambda m: m.value()), *more)
    if not by_year:
        return made
    last = F.max("anio").over(Window.partitionBy())
    return made.withColumn("_last", last).where(F.col("anio") == F.col("_last")).drop("_last", "anio")


def both_rolled_up(df: DataFrame, group: Group, span: Span, rank: str = "period") -> DataFrame:
    """:func:`latest` of towns and :func:`rolled_up` of regions: the towns' rows are made once."""
    df = _dated(df, span, rank).where(F.col("geo_mun_codigo").isNotNull())
    values = {"geo_dep_codigo": F.col("geo_dep_codigo"), **{m.name: m.value() for m in group.measures}}
    rows = latest_per(df, ["geo_mun_codigo"], _order(rank), values, _ties(df, group.source))
    keys = [F.col("geo_dep_codigo"), F.col("geo_mun_codigo")]
    return _levelled(rows.groupingSets([keys, keys[:1]], *keys), _shown_on(group, lambda m: F.max(m.name), lambda m: m.rollup(F.col(m.name))))


def both_latest(df: DataFrame, group: Group, span: Span, rank: str = "period") -> DataFrame:
    """:func:`latest` of towns from their rows and of regions from the rows without a town: each row counts once."""
    df = _dated(df, span, rank).where(F.col("geo_mun_codigo").isNotNull() | F.col("geo_dep_codigo").isNotNull())
    level = F.when(F.col("geo_mun_codigo").isNull(), "region").otherwise("town")
    keyed = df.withColumns({"level": level, "_place": F.coalesce("geo_mun_codigo", "geo_dep_codigo").cast("int")})
    values = {"geo_dep_codigo": F.col("geo_dep_codigo").cast("int"), **{m.name: m.value() for m in group.measures}}
    rows = latest_per(keyed, ["level", "_place"], _order(rank), values, _ties(df, group.source))
    unit = F.when(F.col("level") == "region", 0).otherwise(F.col("_place")).alias("unit")
    return rows.select("level", "geo_dep_codigo", unit, *(m.name for m in group.measures))


def _col(name: str) -> Callable[[], Column]:
    return lambda: F.col(name)


def _text(name: str) -> Callable[[], Column]:
    return lambda: locale_double(F.col(name))


def _null(kind: str) -> Callable[[], Column]:
    return lambda: F.lit(None).cast(kind)


def _sum_if(test: Callable[[], Column] | None = None) -> Callable[[], Column]:
    people = F.col if test is None else None
    return (lambda: F.sum(people("poblacion"))) if people else (lambda: F.sum(F.when(test(), F.col("poblacion")).otherwise(0)))


def _ethnic(*parts: str) -> Callable[[], Column]:
    return _sum_if(lambda: contains_any(F.col("grupo_etnico"), list(parts)))


def _providers(part: str | None = None) -> Callable[[], Column]:
    def count() -> Column:
        institution = F.col("clpr_nombre").ilike("%Instituciones Prestadoras%")
        return F.count_if(institution if part is None else institution & F.col("naju_nombre").ilike(f"%{part}%"))

    return count


def _provider_totals(df: DataFrame, keys: tuple[str, ...], group: Group, grain: str, span: Span) -> DataFrame:
    return totals(df.where(F.col("clpr_nombre").ilike("%Instituciones Prestadoras%")), keys, group, grain, span)


def _both_provider_totals(df: DataFrame, group: Group, span: Span) -> DataFrame:
    return both_totals(df.where(F.col("clpr_nombre").ilike("%Instituciones Prestadoras%")), group, span)


def _rates(names: Mapping[str, str]) -> tuple[Measure, ...]:
    return tuple(Measure(out, "double", _text(raw)) for out, raw in names.items())


def _percent() -> Column:
    return to_double(F.col("Cobertura")) * 100


#: The registry, names and order of the output columns as published.
GROUPS = (
    Group("demografico_edad_sexo", (
        Measure("pob_hombres", "bigint", _sum_if(lambda: F.col("sexo") == "HOMBRES")),
        Measure("pob_mujeres", "bigint", _sum_if(lambda: F.col("sexo") == "MUJERES")),
        Measure("pob_total", "bigint", _sum_if()),
    ), partial(totals, years="capped"), partial(totals, years="capped"), partial(both_totals, years="capped"), overlaid=("region",)),
    Group("demografico_etnico", (
        Measure("pob_etnico_total", "bigint", _sum_if()),
        Measure("pob_indigena", "bigint", _ethnic("ndígen", "ndigen")),
        Measure("pob_gitana_rrom", "bigint", _ethnic("itana", "rrom")),
        Measure("pob_raizal", "bigint", _ethnic("aizal")),
        Measure("pob_palenquera", "bigint", _ethnic("alenquer")),
        Measure("pob_negra_afro", "bigint", _ethnic("egra", "fro")),
        Measure("pob_ninguno", "bigint", _ethnic("ingún", "ningun")),
    ), partial(totals, years="last"), partial(totals, years="last"), partial(both_totals, years="last")),
    Group("reps_prestadores", (
        Measure("ips_total", "bigint", _providers()),
        Measure("ips_publica", "bigint", _providers("ública")),
        Measure("ips_privada", "bigint", _providers("rivada")),
        Measure("ips_mixta", "bigint", _providers("ixta")),
    ), _provider_totals, _provider_totals, _both_provider_totals),
    Group("reps_capacidad", (Measure("capacidad_instalada", "double", lambda: F.sum(to_double(F.col("cantidad")))),), totals, totals, both_totals),
    Group("supersalud_ips_intervenidas", (Measure("ips_intervenidas", "bigint", lambda: F.count(F.lit(1))),), None, totals),
    Group("supersalud_eps_intervenidas", (Measure("eps_intervenidas", "bigint", lambda: F.count(F.lit(1))),), None, totals),
    Group("eps_autorizadas", (Measure("eps_autorizadas", "bigint", _null("bigint")),)),
    Group("afiliacion", (
        Measure("afiliados_subsidiado", "bigint", _col("afiliados_subsidiado"), F.sum),
        Measure("afiliados_contributivo", "bigint", _col("afiliados_contributivo"), F.sum),
        Measure("afiliados_total", "bigint", _col("afiliados_total"), F.sum),
        Measure("cobertura_pct", "double", _percent, F.avg),
    ), partial(latest, rank="month"), partial(rolled_up, rank="month"), partial(both_rolled_up, rank="month"), overlaid=("town", "region")),
    Group("irca", (
        Measure("irca_promedio", "double", _col("promedio_irca"), F.avg),
        Measure("irca_nivel_riesgo", "string", _col("nivel_riesgo")),
    ), partial(latest, rank="month"), partial(rolled_up, rank="month"), partial(both_rolled_up, rank="month"), overlaid=("town", "region"), hidden={"region": ("irca_nivel_riesgo",)}),
    Group("ins_mortalidad_materna", _rates({"razon_mortalidad_materna": "razon_mm_actual"}), latest, partial(latest, whole_region=True), both_latest, overlaid=("town", "region")),
    Group("ins_sifilis_congenita", (
        Measure("casos_sifilis_congenita", "bigint", lambda: locale_bigint(F.col("casos_sc_total"))),
        Measure("incidencia_sifilis_congenita", "double", _null("double")),
    ), None, partial(latest, complete="casos_sc_total"), overlaid=("region",), hidden={"town": ("casos_sifilis_congenita",)}),
    Group("ins_desnutricion_aguda", (
        Measure("casos_desnutricion_aguda", "bigint", lambda: locale_bigint(F.col("casos")), F.sum),
        Measure("prevalencia_desnutricion_aguda", "double", _text("prevalencia_por_100"), F.avg),
    ), latest, rolled_up, both_rolled_up, overlaid=("town", "region"), hidden={"town": ("casos_desnutricion_aguda",)}),
    Group("ins_mortalidad_menores5", _rates({f"tasa_mortalidad_menores5_{c}": f"tasa_{c}" for c in ("dnt", "ira", "eda")}), None, latest, overlaid=("region",)),
    Group("ins_dengue", _rates({"dengue_total": "dengue_total", "dengue_grave_total": "dengue_grave_total", "incidencia_dengue_x100k": "incidencia_x100k"}), None, latest, overlaid=("region",)),
    Group("ins_intento_suicidio", (Measure("tasa_intento_suicidio", "double", _text("tasa"), F.avg),), latest, rolled_up, both_rolled_up, overlaid=("town", "region")),
    Group("ins_violencia_genero", _rates({c: c for c in ("violencia_fisica", "violencia_psicologica", "negligencia_abandono", "violencia_sexual", "violencia_genero_intrafamiliar")}), None, latest, overlaid=("region",)),
    Group("sin_fuente", (Measure("lsp", "double", _null("double")), Measure("vsp", "double", _null("double")), Measure("gestion_riesgo", "string", _null("string")))),
)
#: Columns that an overlay leaves although their group is overlaid.
NOT_OVERLAID = {"region": ("casos_desnutricion_aguda",), "town": ()}


def part(frames: Frames, group: Group, grain: str, span: Span) -> DataFrame | None:
    """A group's columns per key of the grain; None without rule or source."""
    rule = group.town if grain == "town" else group.region
    source = frames.get(group.source)
    if rule is None or source is None:
        return None
    return rule(source, TOWN if grain == "town" else REGION, group, grain, span)


def metric_columns(grain: str) -> list[str]:
    return [m.name for g in GROUPS for m in g.shown(grain)]


def _part_or_none(frames: Frames, group: Group, grain: str, span: Span, lenient: bool) -> DataFrame | None:
    """A group's columns; where it cannot be planned (a column its source has lost), none if ``lenient``."""
    try:
        made = part(frames, group, grain, span)
        if made is not None:
            made.schema  # plans it
        return made
    except AnalysisException:
        if not lenient:
            raise
        log.exception("group left out: %s of %s", group.source, grain)
        return None


def _both_parts(frames: Frames, group: Group, span: Span, lenient: bool) -> DataFrame | None:
    """A group's columns for both grains as rows of LEVEL; None without rule or source."""
    source = frames.get(group.source)
    if source is None:
        return None
    if group.both is None:  # one grain at most has a rule
        grain = "town" if group.town else "region"
        made = _part_or_none(frames, group, grain, span, lenient)
        if made is None:
            return None
        unit = F.col("geo_mun_codigo") if grain == "town" else F.lit(0)
        return made.withColumns({"level": F.lit(grain), "unit": unit.cast("int")})
    try:
        made = group.both(source, group, span)
        made.schema  # plans it
        return made
    except AnalysisException:
        if not lenient:
            raise
        log.exception("group left out: %s of both grains", group.source)
        return None


def wide_both(frames: Frames, town_dim: DataFrame, span: Span = Span(), lenient: bool = False) -> DataFrame:
    """Both tables of :func:`wide` in one, ``level`` town or region, every source read once.

    Store it and take the tables out with :func:`of_grain`.
    """
    named = town_dim.select(F.col("dep_codigo").alias("geo_dep_codigo"), F.col("mun_codigo").alias("geo_mun_codigo"), F.col("dep_dane").alias("departamento"), F.col("mun_dane").alias("municipio"))
    town = named.select(F.lit("town").alias("level"), "geo_dep_codigo", F.col("geo_mun_codigo").alias("unit"), "departamento", "municipio")
    region = regions(town_dim).select(F.lit("region").alias("level"), F.col("dep_codigo").alias("geo_dep_codigo"), F.lit(0).alias("unit"), F.col("dep_dane").alias("departamento"), F.lit(None).cast("string").alias("municipio"))
    out = star(town.unionByName(region), LEVEL, [(_both_parts(frames, g, span, lenient), {m.name: m.kind for m in g.measures}) for g in GROUPS])
    code = F.when(F.col("level") == "town", F.col("unit")).alias("geo_mun_codigo")
    return out.select("level", "geo_dep_codigo", code, "departamento", "municipio", *(m.name for g in GROUPS for m in g.measures))


def of_grain(both: DataFrame, grain: str) -> DataFrame:
    """One of the two tables in a frame of :func:`wide_both`."""
    keys = (*TOWN, "departamento", "municipio") if grain == "town" else (*REGION, "departamento")
    return both.where(F.col("level") == grain).select(*keys, *metric_columns(grain))


def wide(frames: Frames, town_dim: DataFrame, grain: str, span: Span = Span(), lenient: bool = False) -> DataFrame:
    """One row for every town or region, with all indicators; conformed ``frames`` by source name.

    Ethnic groups use the last year there is, later than ``as_of`` or not, as
    published; population stops at ``as_of``.  With ``lenient`` a group that
    cannot be planned gives typed nulls and an error in the log.
    """
    if grain == "town":
        base = town_dim.select(F.col("dep_codigo").alias("geo_dep_codigo"), F.col("mun_codigo").alias("geo_mun_codigo"), F.col("dep_dane").alias("departamento"), F.col("mun_dane").alias("municipio"))
    else:
        base = regions(town_dim).select(F.col("dep_codigo").alias("geo_dep_codigo"), F.col("dep_dane").alias("departamento"))
    parts = [(_part_or_none(frames, g, grain, span, lenient), {m.name: m.kind for m in g.shown(grain)}) for g in GROUPS]
    keys = TOWN if grain == "town" else REGION
    out = star(base, keys, [p for p in parts if p[1]])
    names = ["departamento", "municipio"] if grain == "town" else ["departamento"]
    return out.select(*keys, *names, *metric_columns(grain))
