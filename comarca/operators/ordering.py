"""Top-k and orders with nulls placed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_k(df: DataFrame, metric: str, k: int, tie: Sequence[str]) -> DataFrame:
    """The k greatest of a metric, missing ones left out, equal ones by ``tie``."""
    return df.where(F.col(metric).isNotNull()).orderBy(F.desc(metric), *tie).limit(k)


def top_k_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each key."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")


def by_name(df: DataFrame, *columns: str) -> DataFrame:
    """Ascending with nulls last."""
    return df.orderBy(*(F.asc_nulls_last(c) for c in columns))


def descending(df: DataFrame, metric: str, *tie: str) -> DataFrame:
    """Descending with nulls and NaN last."""
    value = F.when(~F.isnan(metric), F.col(metric))
    return df.orderBy(value.desc_nulls_last(), *tie)


def first_by_preference(df: DataFrame, test: Column, *tie: str) -> DataFrame:
    """One row: one that passes the test if there is one."""
    return df.orderBy(F.when(test, 0).otherwise(1), *(F.asc_nulls_last(t) for t in tie)).limit(1)
