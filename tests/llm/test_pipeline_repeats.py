from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from comarca.llm import mixing


def test_mix_of_rows_that_repeat(spark, docs):
    few = docs.select(*cp.COLUMNS).limit(60).cache()
    df = few.unionByName(few.where("doc_id % 3 = 0")).unionByName(few.where("doc_id % 3 = 0")).unionByName(few.where("doc_id = 0").withColumn("source", F.lit(None).cast("string")))
    got = Counter(map(str, cp.mix_sources(spark, df, "").collect()))
    given = Counter(map(str, df.collect()))
    assert set(got) <= set(given) and all(n <= 3 * given[r] for r, n in got.items())
    target = {r.source: (r.target, r.most) for r in mixing.mix(mixing.sizes(df)).groupBy("source").agg(F.first("target").alias("target"), F.max("size").alias("most")).collect()}
    words = mixing.sizes(cp.mix_sources(spark, df, "")).groupBy("source").agg(F.sum("size").alias("n")).collect()
    taken = {r.source: r.n for r in words}
    for source, (want, most) in target.items():
        assert abs(taken.get(source, 0) - want) <= 2 * most + 1
