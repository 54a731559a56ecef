"""Exact top-k search by inner product over a bit-sliced index.

Method: a block of candidates is kept as bit slices - for each attribute and
bit a bitmap over the rows, offset so that values are not negative.  The
scores of a query are themselves bit slices: the attribute slices, shifted by
the set bits of the query's weights (complemented slices for negative ones),
are added with bitmap full adders.  The k best rows come from the most
significant score slice downward; rows still tied at the last slice have equal
scores and are settled by the smaller id.

Queries and candidates meet in blocks: each block of candidates is indexed
once for each block of queries, in its own task, and returns k rows a query;
the lists of a query are then merged.  No block holds more than its fixed rows.

Defined results: vectors that are null, empty or hold a null or non-finite
component take no part; only vectors of equal length are compared; rows that
repeat an id are candidates each, but never for a query of their own id, and a
query row repeated whole is answered once.  With fewer candidates than k, all
are returned.  Scores are 64-bit: dimensions times the square of the greatest
``scale * x`` must stay below 2**63, and a block whose values could pass that
raises ``OverflowError``.  Columns other than the two named do not
pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null for vectors that take no part."""
    usable = (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


def _pack(flags: np.ndarray) -> np.ndarray:
    """Booleans of rows as 64-bit words."""
    packed = np.packbits(flags, axis=-1, bitorder="little")
    missing = -packed.shape[-1] % 8
    return np.ascontiguousarray(np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, missing)])).view(np.uint64)


def _rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


class BitSlicedIndex:
    """Bit slices of a block of integer vectors, rows in id order."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        low = int(vectors.min())
        self.bits = max(1, (int(vectors.max()) - low).bit_length())
        shifted = (self.vectors - low).T.astype(np.uint64)
        self.slices = np.stack([_pack((shifted >> np.uint64(b)) & np.uint64(1) != 0) for b in range(self.bits)], 1)
        self.complements = ~self.slices
        self.all = _pack(np.ones(len(ids), bool))

    def score_slices(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the query's scores, least significant first.

        They are the scores plus one constant: a complement stands for the
        value range less the value.
        """
        columns: dict[int, list[np.ndarray]] = {}
        for attribute, weight in enumerate(query.tolist()):
            side = self.slices if weight >= 0 else self.complements
            size, shift = abs(weight), 0
            while size >> shift:
                if size >> shift & 1:
                    for b in range(self.bits):
                        columns.setdefault(b + shift, []).append(side[attribute, b])
                shift += 1
        out, place = [], 0
        while columns:
            waiting = columns.pop(place, [])
            while len(waiting) > 1:  # full adders: three slices of a place become a sum here and a carry above
                a, b = waiting.pop(), waiting.pop()
                half = a ^ b
                carry = a & b
                if waiting:
                    c = waiting.pop(0)
                    carry |= half & c
                    half = half ^ c
                waiting.append(half)
                columns.setdefault(place + 1, []).append(carry)
            out.append(waiting[0] if waiting else np.zeros_like(self.all))
            place += 1
        return out

    def top(self, query: np.ndarray, k: int, query_id: int) -> np.ndarray:
        """Rows of the k best candidates for a query, best first."""
        first, last = np.searchsorted(self.ids, [query_id, query_id + 1])
        tied = self.all
        if last > first:
            own = np.zeros(len(self.all) * 64, bool)
            own[first:last] = True
            tied = tied & ~_pack(own)
        sure = np.zeros_like(self.all)
        n_sure = 0
        for bitmap in reversed(self.score_slices(query)):
            high = tied & bitmap
            n = _count(high)
            if n_sure + n > k:
                tied = high
            else:
                sure, n_sure, tied = sure | high, n_sure + n, tied & ~bitmap
                if n_sure == k:
                    break
        rows = np.concatenate([_rows_of(sure), _rows_of(tied)[: k - n_sure]])
        return rows[np.lexsort((self.ids[rows], -(self.vectors[rows] @ query)))]


def _greatest(vectors: np.ndarray) -> int:
    """Greatest magnitude, as a Python integer."""
    return max(abs(int(vectors.min())), abs(int(vectors.max())))


def _search(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def run(candidates: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(candidates) and len(queries):
            index = BitSlicedIndex(candidates["id"].to_numpy(), np.stack(candidates["vector"]).astype(np.int64))
            asked = np.stack(queries["vector"]).astype(np.int64)
            if index.vectors.shape[1] * _greatest(index.vectors) * _greatest(asked) >= 1 << 63:
                raise OverflowError("scores of these vectors may not fit 64 bits: lower the scale")
            for query_id, mark, query in zip(queries["id"], queries["mark"], asked):
                rows = index.top(query, k, query_id)
                found.append(pd.DataFrame({"query_id": query_id, "mark": mark, "id": index.ids[rows], "score": index.vectors[rows] @ query}))
        return pd.concat(found) if found else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "mark", "id", "score")})

    return run


def _blocks(rows: DataFrame, n: int, name: str) -> DataFrame:
    """Rows with a block number by hash of id and content; ``n`` blocks."""
    return rows.withColumn(name, F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int"))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0, candidate_rows: int = 65536, query_rows: int = 256) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` best candidates of every query row.

    ``candidate_rows`` and ``query_rows`` are the mean rows of a block; the
    grid of block pairs is what is spread over the executors.
    """
    usable = vectors.select(F.col(id_col).alias("id"), quantised(F.col(vector_col), scale).alias("vector"), is_query.alias("is_query")).where("id IS NOT NULL AND vector IS NOT NULL")
    size = usable.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    n_candidates, n_queries = max(1, -(-size.n // candidate_rows)), max(1, -(-size.q // query_rows))
    candidates = _blocks(usable.select("id", "vector"), n_candidates, "cb").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(n_queries - 1))))
    queries = _blocks(usable.where("is_query").select("id", "vector").distinct(), n_queries, "qb").withColumns({"cb": F.explode(F.sequence(F.lit(0), F.lit(n_candidates - 1))), "mark": F.xxhash64("vector")})
    keys = ["cb", "qb", F.size("vector").alias("dim")]
    met = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(_search(k), "query_id long, mark long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")
