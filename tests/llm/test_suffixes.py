import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from comarca.llm import suffixes


def brute(texts, length):
    """(removed, spans, digest) of each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if counts[d[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("letters,n,most", [("ab", 400, 1 << 20), ("ab", 400, 64), ("a", 300, 64), ("abcdefgh", 3000, 256), ("aé漢", 500, 1 << 20)])
def test_suffix_order_and_common_prefixes(letters, n, most):
    rng = random.Random(n)
    pieces = ["".join(rng.choice(letters) for _ in range(n)).encode(), b"ab" * 100, b"", b"mississippi" * 9]
    text = np.r_[np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(2), np.uint8(0)]
    raw, cap = text.tobytes(), 60
    got = [(int(s), int(c)) for ss, cc in suffixes.sorted_suffixes(text, cap, most) for s, c in zip(ss, cc)]
    assert sorted(s for s, _ in got) == [i for i in range(len(raw)) if i != len(raw) - 1]
    keys = [raw[s : s + cap] for s, _ in got]
    assert all(a >= b for a, b in zip(keys, keys[1:]))
    for (_, shared), a, b in zip(got[1:], keys, keys[1:]):
        true = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert min(shared, cap) == true


def check(df, length=200, **options):
    rows = df.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), *w) for r, w in zip(rows, brute([r.text for r in rows], length)))
    got = suffixes.remove_repeats(df, length, outputs=("n_bytes", "n_removed", "n_spans", "kept_sha256"), **options).collect()
    assert sorted((str(r.doc_id), r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_documents(docs):
    check(docs)


def test_crowded_names(docs, odd_docs):
    check(docs, crowded=1)
    check(odd_docs, crowded=0)


def test_odd_rows(odd_docs):
    check(odd_docs)
    check(odd_docs, 33)


def test_random_letters(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(0, 90))) for _ in range(60)]
    for length in (16, 20, 24):
        check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), length)


def test_passages_at_every_offset(spark):
    rng = random.Random(9)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(260))
    texts = ["".join(rng.choice("klmnop ") for _ in range(rng.randint(0, 50))) + passage[rng.randint(0, 40) : 260 - rng.randint(0, 25)] + "".join(rng.choice("klm") for _ in range(30)) for _ in range(40)]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_crowded_passage_at_every_level(spark, monkeypatch):
    """The edges of one passage in many texts, split until a cell is one string."""
    monkeypatch.setattr(suffixes, "SPREAD", 1 << 20)
    rng = random.Random(12)
    passage = "".join(rng.choice("abcdefghij ") for _ in range(700))
    texts = ["".join(rng.choice("klmnop ") for _ in range(rng.randint(0, 150))) + passage[rng.choice((0, 0, 3)) :] + "".join(rng.choice("klm") for _ in range(rng.randint(0, 150))) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate([*texts, "-" * 900, "-" * 450 + "x", "ab-" * 400])), "doc_id long, text string")
    check(df, crowded=0)
    check(df, crowded=5)


def test_very_long_and_clashing(spark):
    from pyspark.sql import functions as F

    rng = random.Random(13)
    long = "".join(rng.choice("abcdefghij ") for _ in range(60_000))
    df = spark.createDataFrame([(1, long), (2, "z" * 20_000), (3, long[30_000:30_300]), (4, None), (4, None)], "doc_id long, text string")
    check(df.withColumns({c: F.lit(1) for c in ("row", "name", "spans", "content")}))


def test_empty(docs):
    assert suffixes.remove_repeats(docs.where("false")).count() == 0


def test_long_runs_of_one_name_are_judged_in_parts(spark, monkeypatch):
    session_batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rng = random.Random(10)
        passage = "".join(rng.choice("abcdefghij ") for _ in range(230))
        texts = ["".join(rng.choice("klmnop ") for _ in range(50)) + passage + "".join(rng.choice("klm") for _ in range(50)) for _ in range(60)]
        df = spark.createDataFrame(list(enumerate(texts + texts[:9])), "doc_id long, text string")
        keyed = df.select(*suffixes._row_keys("doc_id", "text"), "text")

        def meet(limit):
            monkeypatch.setattr(suffixes, "HELD_WINDOWS", limit)
            return sorted(map(tuple, suffixes._meet(suffixes._windows(keyed, 200)).select("row", "first", "ends", "sort", "covered").collect()))

        assert meet(0) == meet(1 << 20)
        check(df)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", session_batch)


@pytest.mark.parametrize("period", [1, 2, 3, 47, 60])
def test_periodic_texts(spark, period):
    """A million bytes of a short period are covered in few rows, also against strings of other texts."""
    rnd = random.Random(period)
    unit = "".join(rnd.choice("abcdefgh") for _ in range(period))
    long = unit * (1_000_000 // period)
    texts = [long, "x" * 30 + unit * (300 // period + 1) + "tail of its own", "plain text that is nowhere else", unit * (199 // period), "y" + (unit * 400)[7 : 7 + 200 + period // 2]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    for r in suffixes.remove_repeats(df).collect():
        text, gone = texts[r.doc_id], bytearray(len(texts[r.doc_id]))
        for i in range(len(text) - 199):
            if seen[text[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        assert r.n_removed == sum(gone) and r.kept == bytes(b for b, g in zip(text.encode(), gone) if not g)
    if period < suffixes.gram_of(200):
        grams = np.flatnonzero(suffixes._gram_hashes(np.frombuffer(long.encode(), np.uint8), 48).view(np.int64) == suffixes.windows(long.encode(), 200)[0][0])
        runs = suffixes.periodic_runs(long.encode(), 0, grams, 200)
        assert len(runs) == 1 and runs[0][2] == period and runs[0][1] - runs[0][0] > 999_000
