"""Ordinal periods: months by name, epidemiological periods, stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Names in calendar order; ISO weeks in which a period starts.
MONTHS = ["ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO", "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE"]
ROMAN = ["I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX", "X", "XI", "XII", "XIII"]
PERIOD_WEEKS = 4


def _rank(names: list[str], value: Column) -> Column:
    table = F.create_map(*(F.lit(x) for i, name in enumerate(names, 1) for x in (name, i)))
    return F.coalesce(F.try_element_at(table, value), F.lit(0))


def month_rank(month: Column) -> Column:
    """1..12 by name, any case and outer blanks; 0 for others."""
    return _rank(MONTHS, F.upper(F.trim(month)))


def period_rank(period: Column) -> Column:
    """1..13 by Roman number, matched exactly; 0 for others."""
    return _rank(ROMAN, period)


def period_of_week(week: Column, starts: list[int] | None = None) -> Column:
    """How many periods have started by an ISO week."""
    begun = starts or [1 + PERIOD_WEEKS * i for i in range(len(ROMAN))]
    return F.size(F.filter(F.array(*map(F.lit, begun)), lambda s: week >= s))


def published_period(day: Column) -> Column:
    """struct(year, period) last published on a day: one period behind, over the year's end."""
    iso_year = F.extract(F.lit("YEAROFWEEK"), day)
    behind = period_of_week(F.weekofyear(day)) - 1
    return F.struct(F.when(behind < 1, iso_year - 1).otherwise(iso_year).cast("int").alias("year"), F.when(behind < 1, len(ROMAN)).otherwise(behind).cast("int").alias("period"))


def period_calendar(spark: SparkSession, first_year: int, last_year: int, last_period: int) -> DataFrame:
    """(year, period, name) of all periods up to the last one."""
    years = spark.range(1).select(F.explode(F.sequence(F.lit(first_year), F.lit(last_year))).alias("year"))
    all_ = years.select("year", F.explode(F.sequence(F.lit(1), F.lit(len(ROMAN)))).alias("period"))
    name = F.element_at(F.array(*map(F.lit, ROMAN)), F.col("period"))
    return all_.where((F.col("year") < last_year) | (F.col("period") <= last_period)).withColumn("name", name)


def previous_month(day: Column) -> Column:
    """struct(year, month) before a day's month."""
    before = F.add_months(F.trunc(day, "month"), -1)
    return F.struct(F.year(before).alias("year"), F.month(before).alias("month"))


def month_of_file(name: Column) -> Column:
    """struct(month, year) from names such as Enero-2024.zip; nulls for others."""
    pattern = r"(\w+)-(\d{4})\.zip"
    part = [F.nullif(F.regexp_extract(name, pattern, i), F.lit("")) for i in (1, 2)]
    return F.struct(F.upper(part[0]).alias("month"), part[1].try_cast("int").alias("year"))


def stamp(day: Column) -> Column:
    return F.date_format(day, "yyyy_MM")


def period_of_file(name: Column) -> Column:
    """struct(month, year) from a month's name or its first three letters before a year, as in cifras-oct2025.zip; nulls for others."""
    by_start = {m[:3].lower(): m for m in MONTHS}
    pattern = rf"(?i)({'|'.join(by_start)})[a-z]*[-_ ]?((?:19|20)\d\d)"
    table = F.create_map(*(F.lit(x) for pair in by_start.items() for x in pair))
    return F.struct(F.try_element_at(table, F.lower(F.regexp_extract(name, pattern, 1))).alias("month"), F.regexp_extract(name, pattern, 2).try_cast("int").alias("year"))
