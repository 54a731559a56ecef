import hashlib
import struct

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from comarca.llm import bpe, token_counts

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    data = open(RANKS, "rb").read()
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.parse_ranks(data), special_tokens={})


@pytest.mark.parametrize("table", ["odd_docs", "docs"])
def test_counts_equal_the_library(request, table):
    df = request.getfixturevalue(table)
    path = P.path("word_bpe_49k.json")
    tokenizer = token_counts.load_tokenizer(open(path).read())
    got = token_counts.token_counts(df.withColumn("again", F.col("text")), path).collect()
    assert len(got) == df.count()
    want = [len(e.ids) for e in tokenizer.encode_batch([r.again or "" for r in got], add_special_tokens=False)]
    assert [r.n_tokens for r in got] == want


def test_small_caches_and_tables_change_nothing(odd_docs):
    path = P.path("word_bpe_49k.json")
    df = odd_docs.select("doc_id", "text")
    full = token_counts.token_counts(df, path).collect()
    tiny = token_counts.token_counts(df, path, sample_rows=1, entries=1, cache_entries=5).collect()
    assert sorted(map(str, full)) == sorted(map(str, tiny))


@pytest.mark.parametrize("table", ["odd_docs", "docs"])
def test_bpe_equals_the_library_and_returns(request, library, table):
    df = request.getfixturevalue(table).select("doc_id", F.col("text").alias("again"), "text")
    for r in bpe.encode(df, RANKS, P.PATTERN, outputs=("n_tokens", "ids", "ids_sha256", "decoded")).collect():
        ids = library.encode_ordinary(r.again or "")
        packed = struct.pack(f"<{len(ids)}I", *ids)
        assert (r.n_tokens, bytes(r.ids), bytes(r.decoded)) == (len(ids), packed, (r.again or "").encode())
        assert r.ids_sha256 == hashlib.sha256(packed).hexdigest()


def test_decode_takes_stored_ids(odd_docs):
    encoded = bpe.encode(odd_docs.select("doc_id", F.col("text").alias("again"), "text"), RANKS, P.PATTERN)
    for r in bpe.decode(encoded, RANKS, P.PATTERN).collect():
        assert bytes(r.decoded) == (r.again or "").encode()


def test_empty_table_and_clash(odd_docs):
    assert bpe.encode(odd_docs.where("false").select("doc_id", "text"), RANKS, P.PATTERN).count() == 0
    clash = odd_docs.withColumns({"ids": F.lit(1), "n_tokens": F.lit("x")})
    assert dict(bpe.encode(clash, RANKS, P.PATTERN).dtypes)["ids"] == "binary"
    assert bpe.encode(clash, RANKS, P.PATTERN).count() == odd_docs.count()
    assert dict(token_counts.token_counts(clash, P.path("word_bpe_49k.json")).dtypes)["n_tokens"] == "bigint"


def test_rows_longer_than_the_matrices(library):
    codec = bpe.Codec(open(RANKS, "rb").read(), P.PATTERN, cache_entries=3)
    for text in ("the" * 500, "aab" * 400, "ö" * 257, " " * 900 + "x", "=" * 3000):
        assert codec.encode([text]) == [struct.pack(f"<{len(i)}I", *i) for i in [library.encode_ordinary(text)]]
