"""Conditional aggregates, crosstabs, peer means, quality gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def conditional_sums(df: DataFrame, keys: Sequence[str], value: Column, cases: Mapping[str, Column], total: str | None = None) -> DataFrame:
    """Sum of ``value`` where each case holds (0 elsewhere), and the plain total."""
    sums = [F.sum(F.when(test, value).otherwise(0)).alias(name) for name, test in cases.items()]
    return df.groupBy(*keys).agg(*sums, *([F.sum(value).alias(total)] if total else []))


def conditional_counts(df: DataFrame, keys: Sequence[str], cases: Mapping[str, Column], total: str | None = None) -> DataFrame:
    """Rows for which each case holds, and all rows."""
    counts = [F.count(F.when(test, 1)).alias(name) for name, test in cases.items()]
    return df.groupBy(*keys).agg(*counts, *([F.count(F.lit(1)).alias(total)] if total else []))


def at_maximum(df: DataFrame, column: str, cap: Column | None = None) -> DataFrame:
    """Rows at the greatest value of a column, not over ``cap``."""
    bounded = df if cap is None else df.where(F.col(column) <= cap)
    top = bounded.agg(F.max(column).alias("_top"))
    return bounded.join(F.broadcast(top), F.col(column) == F.col("_top")).drop("_top")


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str], total: str = "total") -> DataFrame:
    """Counts with every listed column present, a row total over all values, most first."""
    counts = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return df.groupBy(row).agg(*counts, F.count(column).alias(total)).orderBy(F.desc(total), F.asc_nulls_last(row))


def pivot_sums(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], value: str) -> DataFrame:
    """Long to wide by sums, missing cells 0."""
    return df.groupBy(*keys).pivot(column, list(values)).sum(value).fillna(0, list(values))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Rows of each value, nulls included, most first."""
    counts = df.groupBy(column).count().orderBy(F.desc("count"), F.asc_nulls_last(column))
    return counts.limit(top) if top else counts


def peer_means(df: DataFrame, columns: Sequence[str], digits: int | None = None) -> DataFrame:
    """One row: the unweighted mean of each column, nulls and text that is no number left out."""
    mean = {c: F.avg(F.when(~F.isnan(F.col(c).try_cast("double")), F.col(c).try_cast("double"))) for c in columns}
    return df.agg(*((F.round(m, digits) if digits is not None else m).alias(c) for c, m in mean.items()))


def share_of_total(df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "share") -> DataFrame:
    """Each row's part of the total of its key; without keys the total is one joined row."""
    if not keys:
        total = df.agg(F.sum(value).alias("_total"))
        return df.join(F.broadcast(total)).withColumn(out, F.try_divide(F.col(value).cast("double"), F.col("_total"))).drop("_total")
    return df.withColumn(out, F.try_divide(F.col(value).cast("double"), F.sum(value).over(Window.partitionBy(*keys))))


def match_rate(df: DataFrame, raw: str, matched: str) -> DataFrame:
    """(matched, total, pct) over rows whose raw name is not null."""
    named = df.where(F.col(raw).isNotNull())
    out = named.agg(F.count_if(F.col(matched).isNotNull()).alias("matched"), F.count(F.lit(1)).alias("total"))
    return out.withColumn("pct", F.coalesce(F.try_divide(100.0 * F.col("matched"), F.col("total")), F.lit(0.0)))


def gated(df: DataFrame, keys: Sequence[str], accepted: Column, least_rows: int, least_rate: float, present: Column | None = None) -> DataFrame:
    """Rows of the groups that are large enough and have enough accepted values.

    With ``present`` (a value is not blank) the rate is over those values, and
    a group without one is rejected.
    """
    rate = F.avg(F.when(present if present is not None else F.lit(True), F.coalesce(accepted, F.lit(False)).cast("double")))
    good = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), rate.alias("_rate")).where((F.col("_n") >= least_rows) & (F.col("_rate") >= least_rate))
    return df.join(good.select(*keys), list(keys), "left_semi")


def mode_of(value: Column) -> Column:
    """Most frequent value, the smallest of equals."""
    return F.mode(value, True)


def median_of(value: Column) -> Column:
    """Exact median."""
    return F.median(value)


@F.pandas_udf(T.LongType())
def _order_key(values: pd.Series) -> pd.Series:
    """Whole numbers in the order of the doubles, NaN last, both zeros one."""
    plain = values.to_numpy(dtype=float)
    bits = (np.where(np.isnan(plain), np.nan, plain) + 0.0).view(np.int64)
    return pd.Series(bits ^ ((bits >> 63) & np.int64(2**63 - 1)))


def grouped_medians(counted: DataFrame, keys: Sequence[str], value: str, times: str, name: str) -> DataFrame:
    """(keys, ``name``): exact median of each group's doubles, each row counted ``times``; null values do not count.

    A group without values has null.  A radix select: four passes count the
    values by 16 bits of their order
    behind those already settled, so a pass keeps some 65,536 counts of a group
    and no task has a group's values.  Nulls are counted 0 times, not filtered,
    so that every pass reads the same rows, which Spark then makes once.
    """
    there = F.when(F.col(value).isNotNull(), F.col(times)).otherwise(0)
    dealt = counted.groupBy(*keys, F.coalesce(_order_key(F.col(value).cast("double")), F.lit(0)).alias("_key")).agg(F.sum(there).alias("_times"), (F.min(F.col(value).cast("double")) + 0.0).alias("_value"))
    sizes = dealt.groupBy(*keys).agg(F.sum("_times").alias("_size"))
    # the middle two ranks, from 0; of an odd number both are the same
    sought = sizes.select(*keys, F.posexplode(F.array(F.shiftright(F.col("_size") - 1, 1), F.shiftright("_size", 1))).alias("_which", "_rank"), F.lit(0).cast("long").alias("_settled"))
    named = [f"_key_{i}" for i in range(len(keys))]
    for shift in (48, 32, 16, 0):
        inside = sought.select(*(F.col(k).alias(n) for k, n in zip(keys, named)), "_which", "_rank", "_settled")
        settled = F.shiftright("_key", shift + 16) if shift < 48 else F.lit(0).cast("long")
        same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named)), settled == F.col("_settled"))
        digits = dealt.join(inside, same).groupBy(*keys, "_which", "_rank", F.shiftright("_key", shift).alias("_settled")).agg(F.sum("_times").alias("_times"), F.min("_value").alias("_value"))
        order = Window.partitionBy(*keys, "_which").orderBy("_settled").rowsBetween(Window.unboundedPreceding, -1)
        placed = digits.withColumn("_before", F.coalesce(F.sum("_times").over(order), F.lit(0)))
        sought = placed.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_times"))).select(*keys, "_which", (F.col("_rank") - F.col("_before")).alias("_rank"), "_settled", "_value")
    none = sizes.where(F.col("_size") == 0).select(*keys, F.lit(None).cast("double").alias("_value"))
    ends = sought.select(*keys, "_value").unionByName(none).groupBy(*keys).agg(F.min("_value").alias("_low"), F.max("_value").alias("_high"))
    return ends.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") * 0.5 + F.col("_high") * 0.5).alias(name))
