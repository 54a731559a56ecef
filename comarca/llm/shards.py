"""Uniform shuffle of rows into shards of exact sizes.

Method: hypergeometric communication matrix.  Rows are dealt into buckets by a
hash of their content; how many rows of each bucket go to each target block is
drawn exactly (multivariate hypergeometric, row by row of the matrix), as a
uniform random permutation of all rows would do it.  Each bucket orders its
rows by a seeded hash and deals them by those counts; the rows are exchanged;
each block orders what it got by a second seeded hash.  Shard sizes differ by
one row at most and slots have no gaps.

Only the matrix (buckets x blocks counts, whatever the data) passes through
the driver.  Everything on rows is DataFrame operations; every order comes
from row content, so a task that runs again makes the same rows.

Defined results: an empty table gives no rows; rows equal in all columns are
interchangeable and keep a slot each; nulls are content like any other.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window, functions as F


def _log_ways(good: int, bad: int, n: int, k: int) -> float:
    """Log of the weight of k good among n drawn, up to a constant."""
    g = math.lgamma
    return -(g(k + 1) + g(good - k + 1) + g(n - k + 1) + g(bad - n + k + 1))


def hypergeometric(rng: random.Random, good: int, bad: int, n: int) -> int:
    """Good items among ``n`` drawn without replacement from ``good + bad``.

    Ratio of uniforms with the published constants; totals may exceed 10**9.
    Narrow ranges are drawn by summing probabilities.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    top = _log_ways(good, bad, n, mode)
    if high - low < 12:
        weights = [math.exp(_log_ways(good, bad, n, k) - top) for k in range(low, high + 1)]
        return rng.choices(range(low, high + 1), weights)[0]
    p = good / total
    mean = n * p + 0.5
    spread = math.sqrt((total - n) * n * p * (1 - p) / max(1, total - 1) + 0.5)
    scale = 1.7155277699214135 * spread + 0.8989161620588988
    while True:
        x, y = rng.random(), rng.random()
        if not x:
            continue
        k = math.floor(mean + scale * (y - 0.5) / x)
        if low <= k <= high and 2 * math.log(x) <= _log_ways(good, bad, n, k) - top:
            return k


def communication_matrix(buckets: list[int], blocks: list[int], seed: int) -> list[list[int]]:
    """Counts with the row sums ``buckets`` and column sums ``blocks`` of a uniform permutation."""
    rng, left, matrix = random.Random(seed), list(blocks), []
    remaining = sum(left)
    for size in buckets:
        row, pool, open_ = [], remaining, size
        for free in left:
            drawn = hypergeometric(rng, free, pool - free, open_) if open_ and free else 0
            row.append(drawn)
            pool -= free
            open_ -= drawn
        left = [a - b for a, b in zip(left, row)]
        remaining -= size
        matrix.append(row)
    return matrix


def even(total: int, parts: int) -> list[int]:
    """``total`` as ``parts`` sizes at most one apart."""
    return [total // parts + (i < total % parts) for i in range(parts)]


def shuffle_into_shards(rows: DataFrame, n_shards: int = 16, seed: int = 7, buckets: int = 256, blocks_per_shard: int = 16) -> DataFrame:
    """``rows`` with ``shard`` (int) and ``slot`` (long, from 0 in each shard).

    ``buckets`` and ``n_shards * blocks_per_shard`` are the widths of the two
    exchanges; raise both where a bucket would outgrow a task.
    """
    spark = rows.sparkSession
    content = [F.col(f"`{c}`") for c in rows.columns]
    dealt = rows.withColumns({"_bucket": F.pmod(F.xxhash64(F.lit(seed), *content), F.lit(buckets)).cast("int"), "_first": F.xxhash64(F.lit(seed + 1), *content), "_second": F.xxhash64(F.lit(seed + 2), *content)})
    held = dict(dealt.groupBy("_bucket").count().collect())
    sizes = [held.get(b, 0) for b in range(buckets)]
    shard_sizes = even(sum(sizes), n_shards)
    blocks = [n for s in shard_sizes for n in even(s, blocks_per_shard)]
    matrix = communication_matrix(sizes, blocks, seed)

    ends, starts, offsets = [], [], []
    for row in matrix:
        total, by_shard, by_block = 0, [], []
        for s in range(n_shards):
            inner = []
            for drawn in row[s * blocks_per_shard : (s + 1) * blocks_per_shard]:
                total += drawn
                inner.append(total)
            by_shard.append(total)
            by_block.append(inner)
        ends.append(by_shard)
        starts.append(by_block)
    for s in range(n_shards):
        at = 0
        for n in blocks[s * blocks_per_shard : (s + 1) * blocks_per_shard]:
            offsets.append(at)
            at += n
    plan = spark.createDataFrame(list(zip(range(buckets), ends, starts)), "_bucket int, _ends array<bigint>, _inner array<array<bigint>>")
    # Bounded whatever the data: buckets x blocks counts.
    ordered = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_bucket").orderBy("_first", "_second"))).join(F.broadcast(plan), "_bucket")
    shard = F.size(F.filter("_ends", lambda e: e < F.col("_r")))
    exchanged = ordered.withColumn("shard", shard).withColumn("_block", F.size(F.filter(F.element_at("_inner", F.col("shard") + 1), lambda e: e < F.col("_r")))).drop("_ends", "_inner", "_r", "_bucket")
    place = F.row_number().over(Window.partitionBy("shard", "_block").orderBy("_second", "_first"))
    base = F.element_at(F.lit(offsets).cast("array<bigint>"), F.col("shard") * blocks_per_shard + F.col("_block") + 1)
    return exchanged.withColumn("slot", base + place - 1).drop("_block", "_first", "_second")
