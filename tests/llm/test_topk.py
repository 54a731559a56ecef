import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from comarca.llm import topk


def brute(rows, k):
    usable = []
    for i, v in rows:
        if v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * x) for x in v]))
    out = {}
    for q, qv in usable:
        if q % 50 == 0:
            scored = [(-sum(a * b for a, b in zip(qv, v)), i) for i, v in usable if i != q and len(v) == len(qv)]
            out[q] = [(rank, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def run(df, **options):
    out = {}
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0, **options).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.id, r.score))
    return {q: sorted(v) for q, v in out.items()}


def test_against_brute_force(spark, sf_small):
    df = spark.read.parquet(f"{sf_small}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()], 5)
    assert run(df) == want
    assert run(df, candidate_rows=7, query_rows=2) == want


def test_odd_vectors(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 0.25]) for _ in range(3)]) for i in range(160)]
    rows += [(200, None), (250, [1.0, None, 0.0]), (300, [1.0, math.nan, 0.0]), (350, [math.inf, 0.0, 0.0]), (400, []), (450, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert run(df) == {q: v for q, v in brute(rows, 5).items() if v}
    few = df.where("vec_id < 3 OR vec_id = 50")
    assert run(few) == brute([r for r in rows if r[0] < 3 or r[0] == 50], 5)
    assert run(df.where("false")) == {}


def test_score_slices_are_scores_plus_a_constant():
    rng = np.random.default_rng(2)
    vectors = rng.integers(-90, 120, (100, 9))
    index = topk.BitSlicedIndex(np.arange(100), vectors)
    query = rng.integers(-50, 50, 9)
    total = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:100].astype(np.int64) << i for i, s in enumerate(index.score_slices(query)))
    assert len(set((total - vectors @ query).tolist())) == 1


def test_repeated_ids_and_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (3, [2.0, 1.0]), (3, [2.0, 1.0]), (3, [-1.0, 1.0]), (7, [0.5, 9.0]), (50, [0.0, 1.0]), (50, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit("x"), "score": F.lit(None).cast("string")})
    scaled = [(i, [256 * int(x * 2) // 2 for x in v]) for i, v in rows]

    def best(query_id, query):  # rows that repeat an id count each; none of the query's own id
        return sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in scaled if i != query_id)[:3]

    for options in ({}, {"candidate_rows": 2, "query_rows": 1}):
        got = {}
        for r in topk.top_k(df, F.col("vec_id") % 50 == 0, k=3, **options).collect():
            got.setdefault(r.query_id, []).append((r.rank, -r.score, r.id))
        assert sorted(got[0]) == [(n, *b) for n, b in enumerate(best(0, [256, 0]), 1)]  # a query repeated whole: once
        both = [(n, *b) for q in ([0, 256], [0, -256]) for n, b in enumerate(best(50, q), 1)]
        assert sorted(got[50]) == sorted(both)  # one id, two vectors: two answers


def test_extreme_magnitudes(spark):
    big = float(1 << 52)
    rows = [(0, [1.0]), (1, [big]), (2, [-big]), (3, [big - 1]), (4, [0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df, scale=1.0) == {0: [(1, 1, 1 << 52), (2, 3, (1 << 52) - 1), (3, 4, 0), (4, 2, -(1 << 52))]}
    over = spark.createDataFrame([(0, [big]), (1, [big])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="OverflowError"):
        run(over)
