"""The sieve lets every row pass whose key is listed, and drops most others."""

from pyspark.sql import functions as F

from comarca.llm import common


def test_sieve(spark):
    rows = spark.range(5000).select(F.xxhash64("id").alias("k"), "id").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, -1L AS id"))
    among = common.durable(rows.where("id % 7 = 0"), "sieve-test")
    kept = {r.id for r in common.sieve(rows, "k", among).collect()}
    assert kept >= set(range(0, 5000, 7)) and len(kept) < 725 and -1 not in kept
    assert common.sieve(rows, "k", among.where("id < 0")).count() == 0
    assert common.sieve_mark(rows, "k", among).columns == ["k", "id", "_may"]
