"""Population sheets, wide by sex and age or by ethnic group, to long tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from comarca.functions.numbers import to_int
from comarca.functions.text import beyond_ascii, collapse_blanks, compatibility_form
from comarca.operators import reshape, tables

#: Identifying columns and what they become; older and newer names of the same column.
IDS = {"DP": "codigo_dep", "DPNOM": "nombre_dep", "MPIO": "codigo_mun", "DPMP": "municipio", "AÑO": "anio", "ÁREA GEOGRÁFICA": "area_geografica"}
RENAMED = {
    "COD_DPTO": "DP", "DEPARTAMENTO": "DPNOM", "COD_DPTO-MPIO": "MPIO", "MUNICIPIO": "DPMP", "AREA GEOGRAFICA": "ÁREA GEOGRÁFICA",
    "Gitano(a) o Rrom": "Gitana o Rrom",
    "Raizal del Archipiélago de San Andrés, Providencia y Santa Catalina": "Raizal",
    "Palenquero(a) de San Basilio": "Palenquera de San Basilio",
    "Negro(a), mulato(a), afrodescendiente, afrocolombiano(a)": "Negra, mulata o afrocolombiana",
    "Ningún grupo étnico-racial": "Ningún grupo",
}
ETHNIC = ["Indígena", "Gitana o Rrom", "Raizal", "Palenquera de San Basilio", "Negra, mulata o afrocolombiana", "Ningún grupo"]
HEADER_KEYS = ["DP", "COD_DPTO", "DEPARTAMENTO"]


def named_sheet(rows: DataFrame) -> DataFrame:
    """Sheet rows (row_no, cells) under their one- or two-row header."""
    head = tables.header_by_names(rows, HEADER_KEYS)
    if head is None:
        raise ValueError("no header row")
    upper, lower = tables.cells_of(rows, head), tables.cells_of(rows, head + 1)
    labels = [str(c).strip().lower() for c in lower if c]
    two = any(c.startswith(("hombres", "mujeres")) for c in labels)
    names = tables.fused_header(upper, lower if two else [])
    body = rows.where(F.col("row_no") > head + (1 if two else 0))
    wide = tables.with_names(body, [n or f"_{i}" for i, n in enumerate(names)]).drop("row_no")
    return reshape.renamed_if_present(wide, RENAMED)


def _tidied(long: DataFrame) -> DataFrame:
    """Identifiers typed; totals over areas and rows without region or year go."""
    out = long.withColumnsRenamed(IDS)
    texts = {c: collapse_blanks(F.col(c)) for c in ("nombre_dep", "municipio", "area_geografica")}
    out = out.withColumns({**texts, "codigo_dep": to_int(F.col("codigo_dep")), "anio": to_int(F.col("anio"))})
    return out.where(F.col("codigo_dep").isNotNull() & F.col("anio").isNotNull() & ~F.coalesce(F.lower("area_geografica").contains("total"), F.lit(False)))


def _with_ids(wide: DataFrame) -> DataFrame:
    """All identifying columns, names in compatibility form: over the distinct names of the sheet, before it is melted."""
    names = [c for c in ("DPNOM", "DPMP", "ÁREA GEOGRÁFICA") if c in wide.columns]
    plain = reshape.over_distinct(wide, names, compatibility_form, beyond_ascii) if names else wide
    return plain.withColumns({c: F.lit(None).cast("string") for c in IDS if c not in plain.columns})


def by_sex_and_age(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Columns such as 'Hombres 12' melted to (sexo, edad, poblacion); blank cells give no row. ``keep`` stays."""
    long = reshape.melt_counts(_with_ids(wide), [*keep, *IDS], r"(?i)^(Hombres|Mujeres)\s+(\d{1,3})", {"sexo": 1, "edad": 2})
    return _tidied(long).withColumn("edad", F.col("edad").cast("int"))


def by_ethnic_group(wide: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The six groups melted to (grupo_etnico, poblacion). ``keep`` stays."""
    groups = [c for c in ETHNIC if c in wide.columns]
    long = reshape.melt(_with_ids(wide).select(*keep, *IDS, *(F.col(f"`{c}`").cast("string").alias(c) for c in groups)), [*keep, *IDS], groups, "grupo_etnico", "_v")
    return _tidied(long.withColumn("poblacion", to_int(F.col("_v"), "bigint")).where("poblacion IS NOT NULL").drop("_v"))


def composition(ethnic: DataFrame) -> DataFrame:
    """Per town and year: a column for each group, their total, and the share that belongs to one."""
    keys = ["codigo_dep", "codigo_mun", "anio"]
    wide = ethnic.groupBy(*keys).pivot("grupo_etnico", ETHNIC).sum("poblacion").fillna(0, ETHNIC)
    total = sum((F.col(f"`{c}`") for c in ETHNIC[1:]), F.col(ETHNIC[0]))
    return wide.withColumn("total", total).withColumn("proporcion", F.bround(F.try_divide((total - F.col("`Ningún grupo`")).cast("double"), total.cast("double")), 6))
