import re
from collections import Counter

from comarca.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    found = WORD.findall(text)
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    counts = Counter(windows)
    covered = {j for i, w in enumerate(windows) if counts[w] > 1 for j in range(i, i + 8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def rows(df):
    return quality.judge(df, keep_text=True).collect()


def test_base_counts(docs, odd_docs):
    for df in (docs, odd_docs):
        for r in rows(df):
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text), r.text
            assert not (r.kept and r.base_failed)


def test_lines(spark):
    clean = "Dies ist ein ganz normaler Satz mit vielen Wörtern, der etwas erzählt.\n" + " ".join(f"wort{i}" for i in range(30)) + "."
    menu = "\n".join(f"Home {i} | About {i} | Contact {i} | Help {i}" for i in range(30))
    page = "\n".join(f"Please accept cookies number {i}" for i in range(30)) + "\n" + "Only this one short sentence is real."
    noise = " ".join(f"wort{i}***" for i in range(60)) + "."
    got = {r.id: r for r in rows(spark.createDataFrame([(1, clean), (2, menu), (3, page), (4, noise)], "id int, text string"))}
    assert not got[4].kept and not got[4].base_failed
    assert got[1].kept and got[1].cleaned == clean
    assert not got[2].kept and not got[3].kept
    assert got[3].cleaned == "Only this one short sentence is real."


def test_most_clean_prose_is_kept(docs):
    judged = rows(docs)
    good = [r for r in judged if not r.base_failed and r.n_symbols * 50 < r.n_words]
    assert sum(r.kept for r in good) > 0.95 * len(good)


def test_empty(docs):
    assert quality.judge(docs.where("false")).count() == 0


def test_clashing_columns(docs):
    from pyspark.sql import functions as F

    got = quality.judge(docs.withColumns({"kept": F.lit("x"), "n_words": F.lit(1.5)}))
    assert dict(got.dtypes)["kept"] == "boolean" and got.count() == docs.count()


def test_menu_rule_is_the_pattern_and_linear(spark):
    import time

    from pyspark.sql import functions as F

    pattern = re.compile(r"[^\W\d_][^|»›•·]*[|»›•·][^|»›•·]*[^\W\d_]")
    lines = ["a|b", "a||b", "|a|", "1|2", "a 1 | 2 b", "x » » y", "a|1|b", "", "|||", "é•漢"]
    got = spark.createDataFrame([(x,) for x in lines], "line string").select("line", quality.lettered_neighbours(F.col("line")).alias("y")).collect()
    assert [r.y for r in got] == [bool(pattern.search(x)) for x in lines]
    began = time.perf_counter()
    long = ["a" * 1_000_000 + "|||", "|" * 300_000, "a " * 500_000, "ab|" * 300_000 + "x" * 1_000_000]
    assert len(rows(spark.createDataFrame([(i, t) for i, t in enumerate(long)], "id int, text string"))) == 4
    assert time.perf_counter() - began < 60


def test_column_named_like_the_inner_one(docs):
    from pyspark.sql import functions as F

    assert {r._words for r in quality.judge(docs.withColumn("_words", F.lit("mine"))).select("_words").distinct().collect()} == {"mine"}
