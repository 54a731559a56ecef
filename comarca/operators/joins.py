"""Star assembly, null-safe bridges, bands, overlays, preferences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F


def star(base: DataFrame, keys: Sequence[str], parts: Sequence[tuple[DataFrame | None, Mapping[str, str]]]) -> DataFrame:
    """Base left-joined with each part on ``keys``; a missing part gives typed nulls.

    A part is (frame or None, column -> type).  Parts must be unique on the keys.
    """
    out = base
    for frame, columns in parts:
        if frame is None:
            out = out.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items()})
        else:
            out = out.join(frame.select(*keys, *(F.col(c).cast(kind).alias(c) for c, kind in columns.items())), list(keys), "left")
    return out


def null_safe_join(left: DataFrame, right: DataFrame, on: Mapping[str, str] | Sequence[tuple[Column, Column]], how: str = "left") -> DataFrame:
    """Join in which nulls equal nulls; the right keys are dropped if given by name."""
    if isinstance(on, Mapping):
        test = reduce(lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in on.items()))
        return left.join(right, test, how).drop(*(right[b] for b in on.values()))
    return left.join(right, reduce(lambda a, b: a & b, (a.eqNullSafe(b) for a, b in on)), how)


def first_per_key(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One value for each key, the smallest, so that a lookup never fans out."""
    return df.groupBy(*keys).agg(F.min(value).alias(value))


def band_of(value: Column, starts: Sequence[float]) -> Column:
    """Number of the band a value is in: 0 below the first start; bands are half-open."""
    return F.size(F.filter(F.array(*(F.lit(float(s)) for s in starts)), lambda s: value >= s))


def midpoint_band(value: Column, starts: Column) -> Column:
    """Place of the column whose start a value is nearest to, by midpoints between starts."""
    middles = F.transform(F.slice(starts, 2, F.greatest(F.size(starts) - 1, F.lit(0))), lambda s, i: (s + F.get(starts, i)) / 2)
    return F.size(F.filter(middles, lambda m: value >= m))


def overlay(base: DataFrame, patch: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace columns by a patch's, all of them or none.

    An empty patch leaves the base; else rows that the patch lacks become null.
    Column order stays.
    """
    some = patch.limit(1).agg((F.count(F.lit(1)) > 0).alias("_some"))
    named = patch.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in columns))
    met = base.join(named, list(keys), "left").join(F.broadcast(some), F.lit(True))
    return met.select(*(F.when(F.col("_some"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns))


def preferred(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of the first frame that has a key; frames share their columns."""
    from .latest import latest_per

    ranked = [f.withColumn("_rank", F.lit(-i)) for i, f in enumerate(frames)]
    every = reduce(lambda a, b: a.unionByName(b), ranked)
    values = {c: F.col(c) for c in frames[0].columns if c not in keys}
    return latest_per(every, keys, [F.col("_rank")], values, list(values.values()))


def mapped(value: Column, table: Mapping) -> Column:
    """Literal lookup, null where absent."""
    return F.try_element_at(F.create_map(*(F.lit(x) for pair in table.items() for x in pair)), value)


def mapped_or_self(value: Column, table: Mapping) -> Column:
    return F.coalesce(mapped(value, table), value)


def interval_join(points: DataFrame, intervals: DataFrame, keys: Sequence[str], value: str, low: str, high: str, width: float, side: int = 4096, block: int = 168) -> DataFrame:
    """Points with every interval of their keys that holds their value, both ends included.

    An equi-join on the keys and bins.  An interval goes to the bins of its
    level, of ``width`` times the power of two that its length is nearest above,
    three at most, and a point to its bin of each level in use; so a long
    interval costs no more rows than a short one.  A bin with more than ``side``
    points or intervals is a grid of cells of about ``side`` by ``side``: each
    row is in one part of its own side and in all parts of the other, so a full
    bin is the work of many tasks, and what a task holds at once is one cell's
    intervals.  Equal rows are in one part.  Null values and ends match nothing.

    The rows of a cell meet as arrays of ``block`` neighbours.  So pairs come
    point by point over the same few intervals again, and files of them, which
    grow with the square of full bins, stay small: an id that stays is a run,
    ids that return are a repeat.  A block is whole groups of the eight values
    that Parquet packs together, so that repeats are equal bytes.
    """
    number = lambda c: F.col(c).cast("double")
    bin_of = lambda c: F.floor(number(c) / (F.lit(float(width)) * F.pow(F.lit(2.0), "_level"))).cast("long")
    # lengths without end are of a level whose bins have none
    level = F.least(F.greatest(F.floor(F.log2((number(high) - number(low)) / F.lit(float(width)))).cast("double"), F.lit(0.0)), F.lit(2000.0)).cast("int")
    whole = intervals.where(F.col(low) <= F.col(high)).withColumn("_level", F.coalesce(level, F.lit(0)))
    reach = F.broadcast(whole.agg(F.min(low).alias("_least"), F.max(high).alias("_most"), F.collect_set("_level").alias("_levels")))
    near = points.join(reach, F.col(value).between(F.col("_least"), F.col("_most"))).select(*points.columns, F.explode("_levels").alias("_level"))

    at = [*keys, "_level", "_bin"]
    near = near.withColumn("_bin", bin_of(value))
    whole = whole.withColumn("_bin", F.explode(F.sequence(bin_of(low), bin_of(high))))
    parts = lambda df, name: df.groupBy(*at).agg(F.ceil(F.count(F.lit(1)) / side).cast("int").alias(name)).where(F.col(name) > 1)
    full = [parts(near, "_rows"), parts(whole, "_spans")]

    def celled(df: DataFrame, columns: Sequence[str], own: str, other: str) -> DataFrame:
        for some in full:
            df = df.join(some, at, "left")
        mine = F.pmod(F.xxhash64(*columns), F.coalesce(own, F.lit(1))).cast("int")
        return df.withColumns({f"{own}_part": mine, f"{other}_part": F.explode(F.sequence(F.lit(0), F.coalesce(other, F.lit(1)) - 1))}).drop("_rows", "_spans")

    near, whole = celled(near, points.columns, "_rows", "_spans"), celled(whole, intervals.columns, "_spans", "_rows")
    cell = [*at, "_rows_part", "_spans_part"]
    # a task's work is its pairs, which the bytes it reads do not tell: the number of tasks is fixed
    n = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def blocks(df: DataFrame, columns: Sequence[str], own: str, least: str, most: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*cell).orderBy(least, most))
        rows = F.collect_list(F.struct(*(c for c in columns if c not in keys)))
        dealt = df.repartition(n, *cell).withColumn("_block", F.floor((place - 1) / block))
        return dealt.groupBy(*cell, "_block").agg(F.min(least).alias(f"{own}_least"), F.max(most).alias(f"{own}_most"), rows.alias(own))

    near, whole = blocks(near, points.columns, "_rows", value, value), blocks(whole, intervals.columns, "_spans", low, high)
    within = F.col(value).between(F.col("_spans_least"), F.col("_spans_most"))
    met = near.join(whole.hint("merge"), cell).where((F.col("_rows_least") <= F.col("_spans_most")) & (F.col("_rows_most") >= F.col("_spans_least")))
    # coalesce to as many tasks moves nothing; it parts the steps, which in one would hold all pairs of two blocks at once
    one = met.coalesce(n).select(*keys, F.inline("_rows"), "_spans", "_spans_least", "_spans_most").where(within)
    pairs = one.coalesce(n).select(*keys, *(c for c in points.columns if c not in keys), F.inline("_spans"))
    return pairs.where(F.col(value).between(F.col(low), F.col(high)))
