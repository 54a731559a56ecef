"""Wide to long, reports, unions of drifting columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from comarca.functions import numbers

from .joins import null_safe_join


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str = "name", value: str = "value") -> DataFrame:
    """One row for each id row and column."""
    return df.unpivot(list(ids), list(columns), name, value)


def melt_counts(df: DataFrame, ids: Sequence[str], pattern: str, parts: Mapping[str, int], value: str = "poblacion") -> DataFrame:
    """Melt the columns whose names match; parts of the name become columns; values that are no integers go."""
    found = [c for c in df.columns if re.match(pattern, c)]
    long = melt(df.select(*ids, *(F.col(f"`{c}`").cast("string").alias(c) for c in found)), ids, found, "_name", "_value")
    number = F.coalesce(F.col("_value").try_cast("bigint"), F.when(F.col("_value").rlike(r"^-?\d+\.0*$"), numbers.to_int(F.col("_value"), "bigint")))
    labels = {n: F.upper(F.trim(F.regexp_extract("_name", pattern, g))) for n, g in parts.items()}
    return long.withColumns({**labels, value: number}).where(F.col(value).isNotNull()).select(*ids, *parts, value)


def renamed_if_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def trimmed_names(df: DataFrame) -> DataFrame:
    return df.toDF(*(c.strip() for c in df.columns))


def ordered_unique(columns: Sequence[str]) -> list[str]:
    return list(dict.fromkeys(columns))


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Rows with nothing but nulls go; call before constants are added."""
    return df.dropna(how="all")


def positive(df: DataFrame, column: str) -> DataFrame:
    """Rows whose value is there and over 0."""
    return df.where(F.col(column) > 0)


def over_distinct(df: DataFrame, columns: Sequence[str], function: Callable[[Column], Column], only: Callable[[Column], Column] | None = None) -> DataFrame:
    """Columns replaced by a costly function of them, called once for each distinct combination.

    ``only`` tells values that the function can change; combinations without
    one are not looked at.  What comes back to the rows is the combinations
    that do change, so the join is with few rows, or none.  Nulls stay null;
    rows and column order stay.
    """
    can_change = [F.coalesce((only or (lambda c: c.isNotNull()))(F.col(f"`{c}`")), F.lit(False)) for c in columns]
    old = [f"_old_{i}" for i in range(len(columns))]
    new = [f"_new_{i}" for i in range(len(columns))]
    values = df.where(reduce(Column.__or__, can_change)).select(*(F.col(f"`{c}`").alias(o) for c, o in zip(columns, old))).distinct()
    made = values.withColumns({n: F.when(F.col(o).isNotNull(), function(F.col(o))) for o, n in zip(old, new)})
    changed = made.where(reduce(Column.__or__, (~F.col(o).eqNullSafe(F.col(n)) for o, n in zip(old, new)))).withColumn("_changed", F.lit(True))
    met = null_safe_join(df, changed, [(F.col(f"`{c}`"), F.col(o)) for c, o in zip(columns, old)])
    places = dict(zip(columns, new))
    return met.select(*(F.when(F.col("_changed"), F.col(places[c])).otherwise(F.col(f"`{c}`")).alias(c) if c in places else F.col(f"`{c}`") for c in df.columns))


def tall_report(row: DataFrame, keys: Sequence[str], catalog: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Wide rows as (keys, metric, amount) joined with the catalogue's labels.

    ``catalog`` has (metric, category, label, unit, region_only).
    """
    wide = row.select(*keys, *(F.col(c).try_cast("double").alias(c) for c in columns))
    return melt(wide, keys, columns, "metric", "amount").join(catalog, "metric")
