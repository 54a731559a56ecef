"""Latest row per entity, and what is rolled up from it.

The winner of a key is found by ``max_by`` over a struct: partial aggregation
before the shuffle, one row per key through it, and Catalyst drops the whole
branch of a left join whose columns nobody reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column], values: Mapping[str, Column] | None = None, tie: Sequence[Column] = ()) -> DataFrame:
    """The row of each key with the greatest ``order``, nulls least; then greatest ``tie``.

    End ``tie`` with something unique where ties can happen, or the pick among
    equal rows is arbitrary.  ``values`` names what is kept; all columns else.
    """
    kept = values or {c: F.col(f"`{c}`") for c in df.columns if c not in keys}
    ranks = F.struct(*(c.alias(f"o{i}") for i, c in enumerate([*order, *tie])))
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*(c.alias(n) for n, c in kept.items())), ranks).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.`{n}`").alias(n) for n in kept))


def complete_first(value: Column) -> Column:
    """Order key that puts rows with a non-empty value before the rest."""
    return (value.isNotNull() & (value.cast("string") != "")).cast("int")


def two_level(df: DataFrame, entity: Sequence[str], group: Sequence[str], order: Sequence[Column], values: Mapping[str, Column], rollup: Mapping[str, Column], tie: Sequence[Column] = ()) -> DataFrame:
    """Latest row of each entity, aggregated per group; the group is the latest row's."""
    carried = {**{g: F.col(g) for g in group if g not in entity}, **values}
    rows = latest_per(df, entity, order, carried, tie)
    return rows.groupBy(*group).agg(*(c.alias(n) for n, c in rollup.items()))
