import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from comarca.llm import queries, variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(rows, every=199, length=6, least=5):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= length and n >= least}


def brute_near(words):
    """Words one edit apart: those that share a pattern with one gap, or one with a letter less."""
    gaps, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            less = w[:i] + w[i + 1 :]
            if less in words:
                near[w].add(less)
                near[less].add(w)
    for group in gaps.values():
        for w in group:
            near[w] |= group - {w}
    return near


def brute(counts, ratio=5):
    near, form, out = brute_near(set(counts)), {}, {}
    for w, n in counts.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-counts[x], x))
            if counts[best] >= ratio * n:
                form[w] = best
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (n, len(near[w]), form.get(w), counts.get(form.get(w)), root)
    return out


def result(df):
    rows = [tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def test_automaton():
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.randint(1, 9))) for _ in range(900)})
    automaton = variants.Automaton(words)
    assert [automaton.number(w) for w in words] == list(range(len(words)))
    assert automaton.number("zz") == -1 and automaton.number("") == -1
    tails = {tuple(sorted(w[i:] for w in words if w[:i] == p)) for w in words for i in range(len(w) + 1) for p in [w[:i]]}
    assert len(automaton.edges) == len(tails)  # minimal: a state for each different set of endings
    near = brute_near(set(words))
    for w in words:
        found = {words[i] for h in (0, len(w) // 2) for i in automaton.one_error(w, h)}
        assert found == {x for x in near[w] if len(x) > len(w) or (len(x) == len(w) and x > w)}


def random_counts(seed, n):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice("abcß") for _ in range(rnd.randint(6, 12))) for _ in range(n // 3)]
    counts = {}
    for s in stems:
        counts[s] = rnd.choice([5, 30, 200, 3000])
        for _ in range(2):
            i = rnd.randrange(len(s) + 1)
            w = rnd.choice([s[:i] + "c" + s[i:], s[:i] + s[i + 1 :], s[:i] + "b" + s[i + 1 :]])
            if len(w) >= 6:
                counts.setdefault(w, rnd.choice([5, 6, 40, 600]))
    return counts


@pytest.mark.parametrize("block_words, block_chars", [(20_000, 1_000_000), (40, 1_000_000), (20_000, 300)])
def test_groups_equal_brute_force(spark, block_words, block_chars):
    counts = random_counts(block_words + block_chars, 900)
    # one beginning for a third of the words, longer than what tasks know of a block; very long words
    rnd = random.Random(9)
    counts |= {"common" * 12 + "".join(rnd.choice("ab") for _ in range(6)): rnd.choice([5, 25, 125, 625, 3125]) for _ in range(300)}
    counts |= {"x" * 3000: 5, "x" * 3001: 40, "x" * 1500 + "y" + "x" * 1500: 900}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert result(variants.group_variants(df, block_words=block_words, block_chars=block_chars)) == brute(counts)


def test_chains_end_in_their_root(spark):
    counts = {"aaaaaa" + "b" * i: 5 ** (i + 1) for i in range(7)}
    out = result(variants.group_variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert out == brute(counts) and out["aaaaaa"][4] == "aaaaaabbbbbb"


def test_counts_and_ties(spark, odd_docs):
    assert {r.word: r.n for r in variants.word_counts(odd_docs, typo_every=199).collect()} == brute_counts([(r.doc_id, r.text) for r in odd_docs.collect()])
    text = "Größen größen GRÖSSEN ÉCOLES écoles KKelvin_kelvin×÷ straße "
    df = spark.createDataFrame([(None, text * 9), (3, None), (4, ""), (5, text * 9), (5, text * 9)], "doc_id int, text string")
    want = brute_counts([(r.doc_id, r.text) for r in df.collect()], every=3)
    assert {r.word: r.n for r in variants.word_counts(df, typo_every=3).collect()} == want and want
    ties = {"wordyx": 5, "wordya": 50, "wordyb": 50}
    assert result(variants.group_variants(spark.createDataFrame(list(ties.items()), "word string, n long")))["wordyx"][2] == "wordya"
    with pytest.raises(ValueError):
        variants.group_variants(df, ratio=1)


def test_empty(spark):
    assert variants.group_variants(spark.createDataFrame([], "word string, n long")).collect() == []
    assert variants.word_counts(spark.createDataFrame([], "doc_id int, text string")).collect() == []


def test_query(spark, sf_small, docs):
    out = queries.op11_spelling_variants(spark, sf_small)
    assert dict(out.dtypes) == {"word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint"}
    assert result(out) == brute(brute_counts([(r.doc_id, r.text) for r in docs.collect()]))
