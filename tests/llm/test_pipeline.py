import hashlib
from collections import Counter

import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as cp
from comarca.llm import bpe, mixing, quality, secret_scan
from comarca.llm.common import durable

from test_near_copies import brute_stay


def rows_of(df):
    return sorted(map(str, df.select(*cp.COLUMNS).collect()))


def test_stages(spark, docs, odd_docs):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(open(P.path("byte_bpe_50k.tiktoken"), "rb").read()), special_tokens={})
    for df in (docs, odd_docs.select(*cp.COLUMNS)):
        one = durable(cp.quality_rules(spark, df, ""), "t")
        kept = quality.judge(df, keep_text=True).where("kept").collect()
        assert rows_of(one) == sorted(str(r) for r in one.select(*cp.COLUMNS).collect()) and one.count() == len(kept)
        assert Counter(r.text for r in one.collect()) == Counter(r.cleaned for r in kept)

        two = durable(cp.near_dedup(spark, one, ""), "t")
        assert Counter(r.doc_id for r in two.collect()) == brute_stay([(r.doc_id, r.text) for r in one.collect()])

        three = durable(cp.secret_scans(spark, two, ""), "t")
        assert Counter(r.doc_id for r in three.collect()) == Counter(r.doc_id for r in two.collect())
        for r in three.collect():
            assert not secret_scan.base_spans(r.text) and r.n_chars == len(r.text)

        four = durable(cp.mix_sources(spark, three, ""), "t")
        mixed = mixing.mix(mixing.sizes(three)).where("copies > 0").agg(F.sum("copies").alias("n")).first().n or 0
        assert abs(four.count() - mixed) <= 3
        assert set(rows_of(four)) <= set(rows_of(three)) and max(Counter(rows_of(four)).values(), default=0) <= 3

        five = cp.encode_tokens(spark, four, "").collect()
        texts = {(r.doc_id, r.n_chars): r.text for r in four.collect()}
        assert len(five) == four.count()
        for r in five:
            text = texts[r.doc_id, r.n_chars]
            assert r.n_tokens == len(library.encode_ordinary(text)) and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_columns_and_reruns(spark, sf_small):
    first, second = (cp.run(spark, sf_small) for _ in range(2))
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    assert [name for name, _ in cp.STAGES] == ["quality_rules", "near_dedup", "secret_scans", "mix_sources", "encode_tokens"]


def test_empty(spark, docs):
    df = docs.where("false")
    for _, stage in cp.STAGES:
        df = durable(stage(spark, df, ""), "t")
    assert df.count() == 0
