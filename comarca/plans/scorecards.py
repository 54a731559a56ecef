"""Performance scorecards of regions, districts and towns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from comarca.functions.numbers import score_label, to_double, to_int
from comarca.operators.joins import mapped
from comarca.sources.xlsx import fixed_width

from .batch import tidy_scorecard

#: Indicators in sheet order, first data rows, town codes of the districts by number.
REGION_INDICATORS = (
    "inspva calidad_gaudi cobertura habilitacion visitas_ips visitas_previas pamec pamec_ips reporte_sic reporte_st004 ips_sic "
    "reporte_525 reporte_526 lvr_crue letalidad_dengue muerte_fa mort_menores5 mort_materna tasa_suicidio reporte_info cuipo "
    "equilibrio_fls ejec_ingresos ejec_compromisos ejec_obligaciones ejec_pagos sgp_oferta_comp sgp_oferta_oblig sgp_sp_comp "
    "sgp_sp_oblig pagos_noupcc facturacion_pna pagos_pna facturacion_migrantes pagos_migrantes deuda_esfuerzo reporte_sns_juegos "
    "inoportunidad_rentas"
).split()
TOWN_INDICATORS = (
    "cobertura listado_censal sisben mort_materna mort_menores5 desnutricion letalidad_dengue reporte_info cuipo equilibrio_fls "
    "ejec_ingresos ejec_compromisos ejec_obligaciones ejec_pagos sgp_subsidiado sgp_sp_comp sgp_sp_oblig reporte_sns_juegos"
).split()
REGION_FIRST_ROW, TOWN_FIRST_ROW = 9, 10
DISTRICTS = {1: 8001, 2: 11001, 3: 76109, 4: 76001, 5: 13001, 6: 47001}


def _pairs(indicators: list[str]) -> list[str]:
    return [f"{i}_{s}" for i in indicators for s in ("res", "pts")]


def regions(rows: DataFrame, kind: str = "departamento") -> DataFrame:
    """Region or district sheet (row_no, cells) as one typed row each, with ``puntaje_promedio``."""
    names = ["nro", "entidad_territorial", *_pairs(REGION_INDICATORS), "extra_res"]
    named = fixed_width(rows.where(F.col("row_no") >= REGION_FIRST_ROW), names)
    town = mapped(to_int(F.col("nro")), DISTRICTS) if kind == "distrito" else F.lit(None).cast("int")
    return tidy_scorecard(named, REGION_INDICATORS).withColumns({"extra_res": to_double(F.col("extra_res")), "tipo": F.lit(kind), "mun_codigo_ref": town})


def towns(rows: DataFrame) -> DataFrame:
    """Town sheet as one typed row each."""
    names = ["nro", "direccion_regional", "codigo_dep", "departamento", "codigo_mun", "municipio", *_pairs(TOWN_INDICATORS)]
    named = fixed_width(rows.where(F.col("row_no") >= TOWN_FIRST_ROW), names)
    return tidy_scorecard(named, TOWN_INDICATORS).withColumns({c: to_int(F.trim(c)) for c in ("codigo_dep", "codigo_mun")})


def score_list(row: DataFrame, indicators: list[str], keys: list[str]) -> DataFrame:
    """(keys, indicator, points, level) of the points that are there."""
    points = [f"{i}_pts" for i in indicators]
    long = row.select(*keys, *points).unpivot(keys, points, "indicator", "points").where("points IS NOT NULL")
    return long.withColumns({"indicator": F.regexp_replace("indicator", "_pts$", ""), "level": score_label(F.col("points"), clamp=False)})
