import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from comarca.llm import common, divergence, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least_docs=3, k=200):
    """Every kept term for every group, as the law says it."""
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = [t.translate(LOWER) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        every = Counter()
        for s in sources:
            every.update({t: counts[lang, s][t] for t in kept})

        def shares(c):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 1) // (total + len(kept)) for t in kept}

        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(every)
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, k)):
                ordered = sorted(items, key=lambda x: (x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, o, -v, i + 1) for i, (v, o) in enumerate(ordered)}
    return out


def check(df, **kw):
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    found = [tuple(r) for r in divergence.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(rows, **kw)
    return found


def test_odd_texts(odd_docs):
    assert check(odd_docs.withColumn("lang", F.when(F.col("id") % 2 == 0, F.col("lang"))))


@pytest.mark.parametrize("k", [1, 3, 40])
def test_equal_values_and_long_shared_beginnings(spark, k):
    rnd = random.Random(k)
    rows = []
    for i in range(90):
        words = ["é" * 30 + f"漢{chr(97 + rnd.randrange(26))}", *(rnd.choice(["alpha", "ALPHA", "beta", "γάμμα", "x"]) for _ in range(rnd.randrange(9)))]
        rows.append((" ".join(words * rnd.randrange(1, 3)) if i % 7 else None, ["a", "b", None][i % 3], f"s{i % 4}" if i % 5 else None))
    df = spark.createDataFrame(rows + rows[:5], "text string, lang string, source string").withColumn("term", F.lit(1))
    check(df, least_docs=2, k=k)


def test_radix_select_without_slack(spark):
    """Passes run to the k-th row itself, over values of any size and items that begin alike."""
    rnd = random.Random(5)
    rows = {(g, rnd.choice(["", "a", "aa", "é"]) * rnd.randrange(4) + str(rnd.randrange(400))): rnd.choice([0, 1, 5, 5, 5, 7 * 10**8, 10**18, rnd.randrange(10**9)]) for g in "pqr" for _ in range(300)}
    df = spark.createDataFrame([(g, item, v) for (g, item), v in rows.items()], "g string, item string, value long")
    keyed = common.durable(df.withColumn("key", divergence.sort_key(F.col("value"), F.col("item"))), "radix-test")
    for k, slack in ((1, 0), (17, 0), (90, 3), (1000, 0)):
        found = {(r.g, r.rank): r.item for r in divergence.radix_top(keyed, ["g"], k, slack).collect()}
        want = {(g, i + 1): item for g in "pqr" for i, (v, b, item) in enumerate(sorted((-v, item.encode(), item) for (h, item), v in rows.items() if h == g)[:k])}
        assert found == want


def test_no_kept_terms_and_empty(spark):
    assert set(check(spark.createDataFrame([("one two", "x", "a"), (None, "x", "b"), ("", "x", "b")], "text string, lang string, source string"))) == {("x", "a", "pair", "b", 0, 1), ("x", "b", "pair", "a", 0, 1)}
    assert divergence.audit(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_query(spark, sf_small, docs):
    out = queries.op13_source_divergence(spark, sf_small)
    assert dict(out.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}
    assert {tuple(r) for r in out.select("lang", "source", "part", "item", "value", "rank").collect()} == brute([(r.text, r.lang, r.source) for r in docs.collect()])
