import datetime

import pytest
from pyspark.sql import functions as F

from comarca.functions import numbers, periods, text


def column(spark, values, kind, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_match_keys(spark):
    raw = ["Villa  Ñandú", "VILLA-NANDU", "P U T U M A Y O", "D C", None, "", "  Bogotá, D.C. ", "áb"]
    assert column(spark, raw, "string", text.geo_key) == ["VILLA NANDU", "VILLA NANDU", "PUTUMAYO", "D C", "", "", "BOGOTA D C", "AB"]
    aliased = column(spark, raw, "string", lambda c: text.geo_key(c, {"D C": "BOGOTA D C"}))
    assert aliased[3] == "BOGOTA D C" and aliased[0] == "VILLA NANDU"


def test_cleaning_and_case(spark):
    assert column(spark, ["﻿a  b\t c ", None], "string", text.collapse_blanks) == ["a b c", None]
    assert column(spark, ["bogotá d.c. (a-b)", "ÉXITO"], "string", text.title_case) == ["Bogotá D.C. (A-B)", "Éxito"]
    assert column(spark, ["Entidad PÚBLICA", "privada", "MIXTA", "x", None], "string", text.legal_nature) == ["Pública", "Privada", "Mixta", None, None]
    assert column(spark, ["ﬁn", None], "string", text.compatibility_form) == ["fin", None]
    assert text.ascii_name(" Ñandú (x) ") == "nandu_x" and text.ascii_name(None) == "col" and text.snake_name(" A B ") == "a_b"
    assert text.unique_names(["a", "a", "a.1", "a"]) == ["a", "a.1", "a.1.1", "a.2"]
    assert text.unique_names(["a", "a"], "_") == ["a", "a_1"]


@pytest.mark.parametrize("make,raw,want", [
    (numbers.to_int, ["5001.0", "5.5", "-2.5", "1e3", "", "12,5", " 12 ", "05001", "1d", None], [5001, 6, -3, 1000, None, None, 12, 5001, None, None]),
    (numbers.locale_double, ["2.069,0", "12.5", "", "-", "12,5", None], [2069.0, 125.0, None, None, 12.5, None]),
    (numbers.locale_bigint, ["2.069", "1,5", "x", "9007199254740993"], [2069, 15, None, 9007199254740993]),
    (numbers.digits_bigint, ["1.234,5", "a"], [12345, None]),
    (numbers.first_comma_double, ["1,5", "1,5,2", "7"], [1.5, None, 7.0]),
    (numbers.padded_code, ["5", "11", "123"], ["05", "11", "123"]),
])
def test_coercion(spark, make, raw, want):
    assert column(spark, raw, "string", make) == want


def test_scores_and_bands(spark):
    assert column(spark, [0.2, 1.5, 2.5, 9.0, None], "double", numbers.score_label) == ["Bajo", "En proceso", "En proceso", "Optimo", None]
    assert column(spark, [0.2, 9.0, None, 3.0], "double", lambda c: numbers.score_label(c, False)) == ["N/D", "N/D", "N/D", "Satisfactorio"]
    assert column(spark, [5.0, 5.1, 35.0, 80.0, 81.0, None], "double", numbers.water_risk) == ["Sin riesgo", "Bajo", "Medio", "Alto", "Inviable", None]
    assert column(spark, [90.0, 89.9, 60.0, 1.0], "double", numbers.coverage_band) == ["Optimo", "Aceptable", "Bajo", "Critico"]
    assert column(spark, [0.0, 14.0, 20.0, 36.0, None], "double", numbers.water_alert) == ["danger", "good", "fair", "danger", "danger"]
    assert column(spark, [1.9, 2.0, 3.2, 3.5, None], "double", numbers.average_band) == ["low", "fair", "good", "optimal", "optimal"]


def test_row_mean_and_formats(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (1.0, 2.0)], "a double, b double")
    assert [r[0] for r in df.select(numbers.row_mean([F.col("a"), F.col("b")])).collect()] == [1.0, None, 1.5]
    assert column(spark, [1234.5, None], "double", lambda c: numbers.number_text(c, F.lit("hab"))) == ["1,234", "—"]
    assert column(spark, [1234.56], "double", lambda c: numbers.number_text(c, F.lit("x100k"))) == ["1,234.6"]
    assert column(spark, [1234.56], "double", lambda c: numbers.number_text(c, F.lit("%"))) == ["1234.6 %"]
    assert column(spark, ["1.5", "x", None, "NaN"], "string", numbers.or_default) == [1.5, 0.0, 0.0, 0.0]
    same = spark.createDataFrame([(True,), (False,)], "s boolean").select(numbers.peers(F.lit(1.0), F.lit(2.0), F.lit(3.0), F.col("s")))
    assert [r[0] for r in same.collect()] == [[1.0, 2.0], [1.0, 2.0, 3.0]]


def test_periods(spark):
    assert column(spark, [" enero ", "Diciembre", "x", None], "string", periods.month_rank) == [1, 12, 0, 0]
    assert column(spark, ["I", "XIII", " I", None], "string", periods.period_rank) == [1, 13, 0, 0]
    days = [datetime.date(2024, 1, 3), datetime.date(2024, 2, 1), datetime.date(2024, 12, 28), datetime.date(2021, 1, 1)]
    assert [tuple(p) for p in column(spark, days, "date", periods.published_period)] == [(2023, 13), (2024, 1), (2024, 12), (2020, 12)]
    assert [tuple(p) for p in column(spark, [datetime.date(2024, 1, 31)], "date", periods.previous_month)] == [(2023, 12)]
    assert column(spark, [datetime.date(2024, 1, 31)], "date", periods.stamp) == ["2024_01"]
    assert [tuple(p) for p in column(spark, ["Enero-2024.zip", "x"], "string", periods.month_of_file)] == [("ENERO", 2024), (None, None)]
    assert periods.period_calendar(spark, 2023, 2024, 2).count() == 15
