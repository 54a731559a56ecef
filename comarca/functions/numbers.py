"""Locale-aware coercion, rounding, bands and formatting."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F


def to_double(text: Column) -> Column:
    """Double or null; a trailing type letter (1d, 2f) is text, not a number."""
    text = text.cast("string")
    return F.when(~text.rlike("[dDfF]\\s*$") | text.rlike("(?i)inf"), text.try_cast("double"))


def to_int(text: Column, kind: str = "int") -> Column:
    """Integer or null; '5001.0', '5.5' and '1e3' count, rounded half away from zero."""
    exact = text.cast("string").try_cast(kind)
    return F.coalesce(exact, F.round(to_double(text)).try_cast(kind))


def locale_double(text: Column) -> Column:
    """Number with dots between thousands and a decimal comma.

    Every dot goes first, so '12.5' is 125: never apply it to dot decimals.
    """
    return to_double(F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def locale_bigint(text: Column) -> Column:
    """Whole number with dots and commas dropped."""
    return to_int(F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit("")), "bigint")


def digits_bigint(text: Column) -> Column:
    """Dots and commas dropped, then a strict cast."""
    return F.regexp_replace(text, "[,.]", "").try_cast("bigint")


def first_comma_text(text: Column) -> Column:
    """The first comma as a dot, later ones as they are."""
    return F.regexp_replace(text, "(?s)^([^,]*),", "$1.")


def first_comma_double(text: Column) -> Column:
    return to_double(first_comma_text(text))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def row_mean(values: Sequence[Column]) -> Column:
    """Mean of the values that are not null; null if none is."""
    total = reduce(lambda a, b: a + b, (F.coalesce(v.cast("double"), F.lit(0.0)) for v in values))
    return F.try_divide(total, reduce(lambda a, b: a + b, (v.isNotNull().cast("int") for v in values)))


def row_sum(values: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, (F.coalesce(v, F.lit(0)) for v in values))


def rounded_ratio(part: Column, whole: Column, digits: int = 6) -> Column:
    """Part over whole, half-even; null where the whole is 0."""
    return F.bround(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def score_level(score: Column) -> Column:
    """Rounded half-even and clamped to 1..4; null without a score."""
    return F.when(score.isNotNull(), F.least(F.lit(4), F.greatest(F.lit(1), F.bround(score).cast("int"))))


#: Labels of score levels and upper limits of the bands.
SCORE_LABELS = {1: "Bajo", 2: "En proceso", 3: "Satisfactorio", 4: "Optimo"}
WATER_BANDS = ([5, 14, 35, 80], ["Sin riesgo", "Bajo", "Medio", "Alto", "Inviable"])
COVERAGE_BANDS = ([90, 75, 60], ["Optimo", "Aceptable", "Bajo", "Critico"])


def score_label(score: Column, clamp: bool = True) -> Column:
    """Label of a score; without ``clamp``, out-of-range and missing ones are N/D."""
    level = score_level(score) if clamp else F.bround(score).cast("int")
    table = F.create_map(*(F.lit(x) for pair in SCORE_LABELS.items() for x in pair))
    label = F.try_element_at(table, level)
    return label if clamp else F.coalesce(label, F.lit("N/D"))


def upper_band(value: Column, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose limit the value does not pass; the last beyond all; null for null."""
    chain = F.when(value.isNull(), None)
    for limit, label in zip(limits, labels):
        chain = chain.when(value <= limit, label)
    return chain.otherwise(labels[len(limits)])


def lower_band(value: Column, limits: Sequence[float], labels: Sequence[str]) -> Column:
    """First label whose limit the value reaches; the last below all; null for null."""
    chain = F.when(value.isNull(), None)
    for limit, label in zip(limits, labels):
        chain = chain.when(value >= limit, label)
    return chain.otherwise(labels[len(limits)])


def water_risk(value: Column, label: Column | None = None) -> Column:
    """Risk band; a given label overrides the computed one."""
    band = upper_band(value, *WATER_BANDS)
    return band if label is None else F.coalesce(F.nullif(label, F.lit("")), band)


def coverage_band(value: Column) -> Column:
    return lower_band(value, *COVERAGE_BANDS)


def water_alert(value: Column) -> Column:
    """Good to 14, fair to 35, else danger; 0 and null count as missing: danger."""
    good = F.coalesce(value, F.lit(0)) != 0
    return F.when(good & (value <= 14), "good").when(good & (value <= 35), "fair").otherwise("danger")


def coverage_alert(value: Column) -> Column:
    """Good from 90 on, else fair; 0 and null count as missing: fair."""
    return F.when((F.coalesce(value, F.lit(0)) != 0) & (value >= 90), "good").otherwise("fair")


def average_band(score: Column) -> Column:
    """Bands of an average score: below 2, 3, 3.5, and above."""
    return F.when(score.isNull() | (score == 0), "optimal").when(score < 2, "low").when(score < 3, "fair").when(score < 3.5, "good").otherwise("optimal")


def number_text(value: Column, unit: Column) -> Column:
    """A value in its unit's form; a dash for null."""
    one, whole = F.format_number(value, 1), F.format_number(F.bround(value), 0)
    percent = F.concat(F.replace(one, F.lit(","), F.lit("")), F.lit(" %"))
    rates = ["pts", "x100k NV", "x100k <5", "x100k"]
    return F.when(value.isNull() | F.isnan(value), "—").when(unit == "%", percent).when(unit.isin(rates), one).otherwise(whole)


def or_default(value: Column, default: float = 0.0) -> Column:
    """A number, or the default for null, NaN and text that is none."""
    number = to_double(value)
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(default))


def is_missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def padded_code(code: Column, width: int = 2) -> Column:
    """Code with zeros in front; longer codes stay whole."""
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def peers(national: Column, region: Column, entity: Column, same: Column) -> Column:
    """[national, region, entity], or [national, region] where the two are one."""
    return F.when(same, F.array(national, region)).otherwise(F.array(national, region, entity))
