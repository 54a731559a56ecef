import hashlib
import re

import pytest
from pyspark.sql import functions as F

from comarca.llm import private_data as pd_, queries

KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    text, out = text or "", []
    only = lambda m: re.sub("[^0-9]", "", m)
    tests = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(only(m)) <= 19 and luhn(only(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(only(m)) <= 15),
    }
    for kind, (pattern, test) in tests.items():
        out += [(m.start(), KINDS.index(kind), m.end(), kind) for m in re.finditer(pattern, text) if test(m[0])]
    return sorted(out)


def listed(spans):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spans)


ODD = [
    "a@b.c_d@e.f x@y z@w. q@r..s .@-.- é@b.co a@b.cé a@b@c.de", "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.01.1 1.2.3 1..2.3.4 999999999999.1.1.1",
    "4111 1111 1111 1111 4111-1111-1111-1111 41111111111111112 4111  1111 1111 1111 0" * 2, "+1 (743) 555-3824. +12345 +1234567890 ++49 30 901820 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +44 20 7946 0958) +4",
    "🎉 a@b.cd 🎉 10.0.0.1 é +49 30 901820 漢 4111111111111111", "1 " * 3000, "1.2.3.4 " * 700, "a@b.co," * 700, "+1 222 333 4444;" * 600, "9" * 40_000, "a" * 40_000 + "@", "1." * 20_000, "+1" + " " * 20_000,
]


@pytest.fixture(scope="module")
def odd(spark, odd_docs):
    rows = [(i, t) for i, t in enumerate([*ODD, *ODD[:3], None, ""])]
    return spark.createDataFrame(rows, "doc_id long, text string").unionByName(odd_docs.select("doc_id", "text"))


@pytest.fixture(scope="module")
def many(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(many):
    return pd_.fit(many)


def test_base_spans(docs, odd):
    for df in (docs.select("doc_id", "text"), odd):
        for r in pd_.scan(df.withColumn("t", F.col("text"))).collect():
            want = brute(r.t)
            assert r.spans == listed(want), r.t[:200]
            assert [r[f"n_{k}"] for k in KINDS] == [sum(x[3] == k for x in want) for k in KINDS]
            assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()


def test_sums_before(spark):
    for n in (0, 1, 255, 256, 257, 1500):
        row = spark.range(1).select(pd_._sums_before(F.expr(f"transform(slice(sequence(1, 2000), 1, {n}), x -> cast(x % 7 as int))")).alias("x")).first()
        assert row.x == [sum(i % 7 for i in range(1, k + 1)) for k in range(n)]


def test_candidates_lie_beside_base_spans(odd):
    for r in odd.select("text", pd_.candidates(F.coalesce("text", F.lit(""))).alias("c")).collect():
        base = [(s, e) for s, _, e, k in brute(r.text) if k == "email"]
        for c in r.c:
            assert (r.text or "")[c.s : c.e] == c.value
            assert not any(s < c.e and c.s < e for s, e in base)


def test_held_out_rows(many, model):
    """Rows of other texts than those the trees were fitted on: what is redacted is right, most is found."""
    rows = pd_.labelled_rows(many)
    given = pd_.features(F.col)
    found = rows.where("fold = 0").select("kind", "label", model.score(given).alias("score")).collect()
    hits = [r for r in found if r.score >= model.least.get(r.kind, 2)]
    assert set(model.least) == set(pd_.GENERATORS)
    assert sum(r.label for r in hits) >= 0.97 * len(hits)
    assert sum(r.label for r in hits) >= 0.9 * sum(r.label for r in found)


def test_spans_beyond_the_base(spark, model):
    texts = {
        "please call 555-301-9922 or mail jane.doe (at) example (dot) com today": ["soft_number", "soft_email"],
        "contact host 2001:db8:12:7:9:3 about it": ["soft_ip"],
        "konto DE89 3704 0044 0532 0130 0042 danke": ["soft_account", "soft_number"],  # both, one in the other
        "released 2024-01-31 as version 2.0.1 for 12,500 people in 2023-2024": [],
        "we arrive at 10.30 and look at section.4": [],
        "a plain text without any of this": [],
    }
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    for r in pd_.scan(df.withColumn("t", F.col("text")), model=model).collect():
        assert sorted(s.split(":")[0] for s in r.spans.split(",") if s) == sorted(texts[r.t]), (r.t, r.spans)


def test_redaction_and_columns(spark, model):
    text = "mail 52@mail1.example.com, é call 555-301-9922 now"
    df = spark.createDataFrame([(1, text, 7, "x", 9), (1, text, 7, "x", 9), (2, None, 0, None, 1)], "doc_id int, text string, spans int, _text string, n_ip int")
    rows = pd_.scan(df, model=model, redact=True).orderBy("doc_id").collect()
    assert [r.text for r in rows] == ["mail [email], é call [soft_number] now"] * 2 + [""]
    assert [(r._text, r.n_ip, r.n_email) for r in rows] == [("x", 0, 1), ("x", 0, 1), (None, 0, 0)]
    both = F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("rank"), F.lit(4).alias("e"), F.lit("a").alias("kind")), F.struct(F.lit(2).alias("s"), F.lit(1).alias("rank"), F.lit(6).alias("e"), F.lit("b").alias("kind")))
    assert spark.range(1).select(pd_.redacted(F.lit("0123456789"), both).alias("t")).first().t == "[a]6789"


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], "doc_id int, text string")
    assert pd_.fit(empty) is None and pd_.scan(empty).collect() == []
    assert pd_.fit(spark.createDataFrame([(1, "plain"), (2, None)], "doc_id int, text string")) is None


def test_no_python_workers(docs, model):
    plan = pd_.scan(docs, model=model)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_query(spark, sf_small, docs):
    out = queries.op12_private_data(spark, sf_small)
    assert dict(out.dtypes) == {"doc_id": "bigint", **{f"n_{k}": "bigint" for k in KINDS}, "base_sha256": "string", "spans": "string"}
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = out.collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(x[3] == k for x in want) for k in KINDS]
        assert {x for x in listed(want).split(",") if x} <= set(r.spans.split(","))
