"""Mixing sources to target weights by balanced sampling.

Method: cube method.  A source that should give f times its size gives
floor(f) copies of every document, and one more of a balanced sample of
inclusion probability f - floor(f).  The flight phase moves three fractional
probabilities at a time along the null-space of two constraints - the words
and the documents taken - until one of them is 0 or 1, so both totals stay put.
It runs in groups of a bounded size within each source; the two or fewer units
that a group leaves meet in groups of the next level, and the last group lands
by giving up the document total, then the word total.

Targets are set by water filling over one row per source.

Defined results: a null text has size 0; a null source is a source, last in
order; an empty table gives no rows.  Draws depend on row content and the seed
alone, so reruns agree; rows equal in id, size and source are interchangeable.
Sources are few (one row each passes through one task when targets are set).
Columns other than id, source and size do not pass through.
"""

from __future__ import annotations

import math
import random
import zlib
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import durable, words

_SETTLED = 1e-9


def targets(by_source: DataFrame, weights: Sequence[float], most: float = 3.0) -> DataFrame:
    """Add ``target`` to rows of (source, source_size), one for each source.

    Weights repeat over the sources in code-point order, null last.  A target
    stops at ``most`` times its source's size; sorted by that limit over the
    weight, the sources that stop are a prefix, found by running sums.
    """
    everything = Window.orderBy("_limit", F.asc_nulls_last("source")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy()
    by_name = F.row_number().over(Window.orderBy(F.asc_nulls_last("source")))
    ranked = by_source.withColumn("_w", F.element_at(F.array(*map(F.lit, map(float, weights))), ((by_name - 1) % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_limit", most * F.col("source_size") / F.col("_w"))
    sums = ranked.withColumns({"_all": F.sum("source_size").over(whole), "_before": F.sum(most * F.col("source_size")).over(everything) - most * F.col("source_size"), "_open": F.sum("_w").over(whole) - F.sum("_w").over(everything) + F.col("_w")})
    level = F.greatest((F.col("_all") - F.col("_before")) / F.col("_open"), F.lit(0.0))
    stops = sums.withColumn("_level", level).withColumn("_final", F.min(F.when(F.col("_limit") >= F.col("_level"), F.struct("_limit", "_level"))).over(whole)["_level"])
    target = F.when(F.col("source_size") > 0, F.least(most * F.col("source_size"), F.col("_w") * F.col("_final"))).otherwise(0.0)
    return stops.select(*by_source.columns, target.alias("target"))


def _flight(sizes: list[float], chance: list[float], active: list[int], rng: random.Random, constraints: int) -> list[int]:
    """Move ``chance`` in place until at most ``constraints`` of ``active`` are fractional; those are returned."""
    held: list[int] = []
    for unit in active:
        if _SETTLED < chance[unit] < 1 - _SETTLED:
            held.append(unit)
        else:
            chance[unit] = float(round(chance[unit]))
        while len(held) > constraints:
            if constraints == 2:
                a, b, c = (sizes[u] for u in held)
                move = [c - b, a - c, b - a] if a != b or b != c else [1.0, -1.0, 0.0]
            elif constraints == 1:
                a, b = (sizes[u] for u in held)
                move = [b, -a] if a or b else [1.0, -1.0]
            else:
                move = [1.0]
            up = min((1 - chance[u] if m > 0 else chance[u]) / abs(m) for u, m in zip(held, move) if m)
            down = min((chance[u] if m > 0 else 1 - chance[u]) / abs(m) for u, m in zip(held, move) if m)
            step = up if rng.random() * (up + down) < down else -down
            for u, m in zip(held, move):
                chance[u] += step * m
                if chance[u] <= _SETTLED or chance[u] >= 1 - _SETTLED:
                    chance[u] = float(round(chance[u]))
            held = [u for u in held if 0 < chance[u] < 1]
    return held


def _balancer(seed: int, last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        return _balance(group, seed, last)

    return run


def _balance(group: pd.DataFrame, seed: int, last: bool) -> pd.DataFrame:
    group = group.sort_values(["_order", "size"], kind="stable")
    sizes, chance = group["size"].astype(float).tolist(), group["_chance"].tolist()
    label = f"{seed}/{group['source'].iloc[0]!r}/{group['_group'].iloc[0]}"
    rng = random.Random(zlib.crc32(label.encode()))
    left = _flight(sizes, chance, list(range(len(group))), rng, 2)
    for constraints in (1, 0) if last else ():
        left = _flight(sizes, chance, left, rng, constraints)
    return group.assign(_chance=chance)


def mix(sized: DataFrame, id_col: str = "doc_id", weights: Sequence[float] = (5, 2, 1), most: float = 3.0, seed: int = 11, group_rows: int = 4096) -> DataFrame:
    """Copies that a mix takes of each row of (id, ``source``, ``size``).

    ``sized`` is read several times and should be stored.  Returns (id, source,
    size, source_size, target, copies long); the mix takes ``copies * size``
    words of a row, near ``target`` over each source, and never over ``most``
    copies.
    """
    per_source = sized.groupBy("source").agg(F.coalesce(F.sum("size"), F.lit(0)).alias("source_size"), F.count(F.lit(1)).alias("_rows"))
    counted = durable(targets(per_source, weights, most).withColumnRenamed("source", "_source"), "mix-targets")
    largest = counted.agg(F.max("_rows")).first()[0] or 0
    factor = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    rows = sized.select(F.col(id_col), "source", "size").join(counted, F.col("source").eqNullSafe(F.col("_source"))).withColumn("_factor", factor)
    rows = rows.select(id_col, "source", "size", "source_size", "target", F.floor("_factor").alias("_whole"), (F.col("_factor") - F.floor("_factor")).alias("_chance"), F.xxhash64(F.lit(seed), id_col, "size").alias("_order"), F.ceil(F.col("_rows") / group_rows).alias("_groups"))
    rows = rows.withColumn("_group", F.pmod("_order", F.col("_groups")))
    levels, groups = [], math.ceil(largest / group_rows)
    while True:
        levels.append(groups)
        if groups <= 1:
            break
        groups = math.ceil(groups * 2 / group_rows)
    settled, open_ = [], rows
    for depth, _ in enumerate(levels):
        last = depth == len(levels) - 1
        moved = open_.groupBy("source", "_group").applyInPandas(_balancer(seed, last), rows.schema)
        if last:
            settled.append(moved)
            break
        moved = durable(moved, f"mix-level{depth}")
        fractional = (F.col("_chance") > 0) & (F.col("_chance") < 1)
        settled.append(moved.where(~fractional))
        open_ = moved.where(fractional).withColumn("_groups", F.ceil(F.col("_groups") * 2 / group_rows)).withColumn("_group", F.pmod("_order", F.col("_groups")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out.select(id_col, "source", "size", "source_size", "target", (F.col("_whole") + F.col("_chance").cast("long")).alias("copies"))


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, source, size): the number of words of each text, stored."""
    return durable(docs.select(id_col, "source", F.size(words(F.col(text_col))).cast("long").alias("size")), "mix-sizes")
