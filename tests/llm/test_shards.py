import random
from collections import Counter, defaultdict

from comarca.llm import shards


def test_hypergeometric_matches_its_mean_and_variance():
    rng = random.Random(3)
    for good, bad, n in ((50, 70, 40), (5, 500, 60), (4000, 1000, 2500), (3, 3, 6)):
        drawn = [shards.hypergeometric(rng, good, bad, n) for _ in range(4000)]
        total = good + bad
        mean = n * good / total
        var = n * good * bad * (total - n) / total / total / (total - 1)
        assert abs(sum(drawn) / 4000 - mean) < 5 * (var / 4000) ** 0.5 + 1e-9
        assert abs(sum((d - mean) ** 2 for d in drawn) / 4000 - var) < 0.2 * var + 1e-9


def test_large_totals():
    k = shards.hypergeometric(random.Random(1), 3 * 10**10, 5 * 10**10, 10**9)
    assert abs(k - 375_000_000) < 10**5


def test_matrix_sums():
    rows, blocks = [5, 0, 900, 33], shards.even(938, 7)
    matrix = shards.communication_matrix(rows, blocks, 5)
    assert [sum(r) for r in matrix] == rows and [sum(c) for c in zip(*matrix)] == blocks


def test_sizes_slots_and_reruns(spark, docs, odd_docs):
    for df in (docs, odd_docs):
        got = shards.shuffle_into_shards(df, 16).collect()
        assert len(got) == df.count()
        sizes = Counter(r.shard for r in got)
        assert max(sizes.get(s, 0) for s in range(16)) - min(sizes.get(s, 0) for s in range(16)) <= 1
        slots = defaultdict(list)
        for r in got:
            slots[r.shard].append(r.slot)
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        again = shards.shuffle_into_shards(df.repartition(5), 16).collect()
        assert sorted(map(str, got)) == sorted(map(str, again))


def test_empty(docs):
    assert shards.shuffle_into_shards(docs.where("false"), 16).count() == 0


def test_clashing_columns(docs):
    from pyspark.sql import functions as F

    got = shards.shuffle_into_shards(docs.withColumns({"shard": F.lit("x"), "slot": F.lit(1.5)}), 4)
    assert dict(got.dtypes)["shard"] == "int" and got.count() == docs.count()
