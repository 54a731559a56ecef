import itertools
import random
from collections import Counter

import corpus_pipeline as cp
from comarca.llm import near_copies


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_stay(rows):
    """Ids that stay: the smallest of each group that chains of similarity 0.8 connect."""
    sets, up = [shingle_set(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            up[root(i)] = root(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return Counter(min(ids, key=lambda d: (d is None, d or 0)) for ids in groups.values())


def stays(df):
    return Counter(r.doc_id for r in cp.near_dedup(df.sparkSession, df, "").collect())


def edited(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def test_stage_finds_copies_at_similarity_eight_tenths(spark):
    rng = random.Random(4)
    texts = []
    for _ in range(150):
        words = [f"w{rng.randrange(500)}" for _ in range(200)]
        texts += [" ".join(words), edited(rng, words, rng.randint(1, 7))]
    df = frame(spark, texts)
    assert stays(df) == brute_stay([(r.doc_id, r.text) for r in df.collect()])


def test_crowded_group(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(500)}" for _ in range(200)]
    df = frame(spark, [edited(rng, words, 2) for _ in range(300)])
    assert stays(df) == {0: 1}


def test_small_data(docs, odd_docs):
    for df in (docs, odd_docs):
        df = df.select(*cp.COLUMNS)
        assert stays(df) == brute_stay([(r.doc_id, r.text) for r in df.collect()])


def test_rounds_lose_no_pair_of_a_key(spark, monkeypatch):
    """One hub a key and round: groups are still those of all pairs."""
    monkeypatch.setattr(near_copies, "HUBS", 1)
    monkeypatch.setattr(near_copies, "CROWDED", 60)
    rng = random.Random(6)
    words = [f"w{rng.randrange(500)}" for _ in range(200)]
    texts = [edited(rng, words, rng.choice((1, 2, 3, 12, 14))) for _ in range(120)]
    df = frame(spark, texts)
    assert stays(df) == brute_stay(list(enumerate(texts)))
