"""Quality rules on whole texts, with DataFrame functions only.

Method: line-first cleaning.  Punctuation, navigation and boilerplate rules
judge each line; failing lines go; a document that loses too much of its text
to them is rejected, as is one that fails the base counts.  Clean documents
keep nearly all their lines whatever their language, so the line rules are
narrow: only short lines fail for want of a sentence mark.

Everything happens inside a row: no shuffle, no exploded words.  Repeated
eight-word windows are found by a 64-bit hash of each window; only texts in
which some window repeats are sorted.  Within one text a hash collision of
different windows is less likely than 1 in 10**8 even at 500,000 words.

Defined results: a null or blank text has no words and fails the base rules;
repeated rows are judged each; other columns pass through, and those named as
outputs give way to them.  Time is linear in a text but for the sort of its
windows, also where a line or a word is very long.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import SPACE_CLASS, words

WINDOW = 8
#: Phrases of page furniture, in lower case.
BOILERPLATE = [
    "lorem ipsum", "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy",
    "use of cookies", "accept cookies", "enable javascript", "sign up for our newsletter", "subscribe to our",
    "click here to", "share on facebook", "share on twitter", "skip to content", "powered by wordpress",
]
#: Marks that separate the items of a menu line.
_MENU = r"[|»›•·]"
_MARK_AT_END = r"""[.!?…。！？:;,"'”’»)\]}>*#$%&|]$"""
_WORD = r"[^\x20\x09-\x0D]"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, whatever its uses."""
    return F.transform(F.array(value), body)[0]


def symbol_count(text: Column) -> Column:
    """Characters of ``[#*$%&|<>]``."""
    return F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long")


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(_WORD))
    return let(lines, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))


def repeated_words(found: Column) -> Column:
    """Words inside the windows of eight that occur twice or more."""
    hashes = F.transform(found, lambda w: F.xxhash64(w))
    windows = let(hashes, lambda h: F.transform(F.sequence(F.lit(1), F.size(h) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(h, i, WINDOW))))

    def covered(ws: Column) -> Column:
        placed = F.array_sort(F.transform(ws, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
        twice = let(placed, lambda ps: F.filter(ps, lambda p, k: (F.get(ps, k - 1)["w"] == p["w"]) | (F.get(ps, k + 1)["w"] == p["w"])))
        starts = F.array_sort(F.transform(twice, lambda p: p["i"]))
        return let(starts, lambda ss: F.aggregate(F.transform(ss, lambda s, k: F.least(F.coalesce(F.get(ss, k + 1) - s, F.lit(WINDOW)), F.lit(WINDOW))), F.lit(0), lambda a, x: a + x))

    some = let(windows, lambda ws: F.when(F.size(F.array_distinct(ws)) < F.size(ws), covered(ws)).otherwise(0))
    return F.when(F.size(found) > WINDOW, some).otherwise(0).cast("long")


def lettered_neighbours(line: Column) -> Column:
    """Whether a separator stands between two items with letters; linear in the line."""
    lettered = F.transform(F.split(line, _MENU, -1), lambda item: item.rlike(r"\p{L}"))
    return let(lettered, lambda ls: F.size(F.filter(ls, lambda has, i: has & F.coalesce(F.get(ls, i + 1), F.lit(False)))) > 0)


def failing_line(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules for one line.

    A blank line does not fail.  Punctuation: under eight words and no mark at
    the end, or three words and more with three symbols to every two words.
    Navigation: three or more menu separators with words between, at
    least one to four words.  Boilerplate: under 30 words with a listed phrase.
    """
    def judged(text: Column, n_words: Column) -> Column:
        symbols = F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))
        separators = F.length(F.regexp_replace(text, r"[^|»›•·]+", ""))
        bare = (n_words < 8) & ~text.rlike(_MARK_AT_END)
        noisy = (n_words >= 3) & text.rlike(r"[#*$%&|<>]") & (2 * symbols >= 3 * n_words)
        menu = text.rlike(_MENU) & (separators >= 3) & (n_words - separators <= 4 * separators) & lettered_neighbours(text)
        furniture = (n_words < 30) & F.lower(text).rlike("|".join(BOILERPLATE))
        return (text != "") & (bare | noisy | menu | furniture)

    trimmed = F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))
    return let(trimmed, lambda text: let(F.size(F.split(text, SPACE_CLASS)), lambda n_words: judged(text, n_words)))


def clean_lines(text: Column) -> Column:
    """The text without its failing lines."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~failing_line(line)), "\n")


def judge(docs: DataFrame, text_col: str = "text", least_words: int = 20, most_repeated: int = 30, most_lost: float = 0.6, keep_text: bool = False) -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``lost_share`` and ``kept``.

    ``cleaned`` (the text without failing lines) is added, and the text stays,
    if ``keep_text``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    found_col = "_words"
    while found_col in docs.columns:
        found_col += "_"
    found = F.col(found_col)
    counts = {
        "n_words": F.size(found).cast("long"),
        "word_chars": F.length(F.array_join(found, "")).cast("long"),
        "n_symbols": symbol_count(text),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated_words(found),
        "cleaned": clean_lines(text),
    }
    worded = docs.drop(*counts, "base_failed", "lost_share", "kept").withColumn(found_col, words(F.col(text_col)))
    # a generator: filters on the verdict stay above it and compute nothing again
    out = worded.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in counts.items())))))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    lost = 1 - F.length(F.regexp_replace("cleaned", SPACE_CLASS, "")) / F.col("word_chars")
    out = out.withColumns({"base_failed": failed, "lost_share": F.when(F.col("word_chars") > 0, lost).otherwise(0.0)}).withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= most_lost))
    return out.drop(found_col) if keep_text else out.drop(found_col, "cleaned", text_col)
