"""Audit of how the sources of a language differ from each other and from the language.

Each (lang, source) group and each language gives every kept term a share of a
milliard, smoothed by one; a term is kept in a language if enough of its
documents have it.  ``f(p, q) = floor((p - q)**2 / q)``.

Method, pairs: sparse baseline-corrected sums.  A term that a source lacks has
the source's baseline share, so a pair's sum is the baseline term times the
number of kept terms, corrected by a source's own terms against the other's
baseline (from a histogram of shares, as shares repeat) and by the terms that
both have (the only ones met one by one).

Method, ranks: radix select.  A row's sort key is bytes: leading bits of the
value, the value, the UTF-8 bytes of the item, so that the smaller key ranks
higher.  Histograms over two key bytes, counted in every task and summed, find
the bytes in which a group's k-th row lies, then the next two inside them,
past all bytes that its rows share; values come first, tied ones go on by the
item's bytes.  Only rows up to the threshold are sorted.

Shares are exact: counts are multiplied as decimals of 38 digits, and the sums
of f stay below 2**63 for up to 5 * 10**8 kept terms of a language (beyond,
Spark raises an error).

Defined results: null text, lang or source count as ''; repeated rows count
each; a group without kept terms has its pairs, and value 0 if its language
keeps none; an empty table gives no rows.  The result has a row for each two
sources of a language by contract, so it grows with the square of their number.
Columns beyond those named are not read, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import durable, lower_ascii_text

#: A term of a text in lower case: letters of ASCII and all characters beyond it.
TERM = r"[^\x00-\x60\x7B-\x7F]+"
GROUP = ["lang", "source"]
#: Rows beyond the k-th that a group may have left when its selection ends.
SLACK = 1000
_DIGIT = 2


def share(n: Column, total: Column, kinds: Column) -> Column:
    """1 + floor(10**9 * (n + 1) / (total + kinds)), exact."""
    return F.lit(1) + F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)"), (total + kinds).cast("decimal(20,0)"))


def gain(p: Column, q: Column) -> Column:
    """floor((p - q)**2 / q) of long shares."""
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and documents with the term."""
    named = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in (*GROUP, "text")))
    found = named.select(*GROUP, F.regexp_extract_all(lower_ascii_text(F.col("text")), F.lit(TERM), F.lit(0)).alias("_t"))
    # each text's terms, then its different ones: the place tells which
    placed = found.select(*GROUP, F.size("_t").alias("_n"), F.posexplode(F.concat("_t", F.array_distinct("_t"))).alias("_at", "term"))
    again = F.col("_at") < F.col("_n")
    return placed.groupBy(*GROUP, "term").agg(F.count_if(again).alias("n"), F.count_if(~again).alias("docs"))


def kept_terms(counts: DataFrame, least_docs: int) -> DataFrame:
    """(lang, term, lang_n) of the terms that ``least_docs`` documents of the language have."""
    whole = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("_docs"))
    return whole.where(F.col("_docs") >= least_docs).drop("_docs")


def group_table(docs: DataFrame, dealt: DataFrame, kept: DataFrame) -> DataFrame:
    """(lang, source, total, kinds, lang_total, base) of every occurring group."""
    every = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in GROUP)).distinct()
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kinds"), F.sum("lang_n").alias("lang_total"))
    totals = dealt.groupBy(*GROUP).agg(F.sum("n").alias("total"))
    out = every.join(langs, "lang", "left").join(totals, GROUP, "left").na.fill(0, ["total", "kinds", "lang_total"])
    return out.withColumn("base", F.when(F.col("kinds") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kinds"))))


def pair_values(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): divergence of each source from each other of its language."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("base").alias("other_base"))
    met = groups.select("lang", "source", "kinds", "base").join(other, "lang").where("source <> item")
    plain = met.select("lang", "source", "item", (F.col("kinds") * gain(F.col("base"), F.col("other_base"))).alias("value"))

    # a source's own terms against the other's baseline, as the pair's p and as its q
    spread = shares.groupBy(*GROUP, "p", "base").agg(F.count(F.lit(1)).alias("times"))
    p, base, theirs = F.col("p"), F.col("base"), F.col("other_base")
    single = spread.join(other, "lang").where("source <> item").select("lang", "source", "item", (F.col("times") * (gain(p, theirs) - gain(base, theirs))).alias("ahead"), (F.col("times") * (gain(theirs, p) - gain(theirs, base))).alias("behind"))
    single = single.groupBy("lang", "source", "item").agg(F.sum("ahead").alias("ahead"), F.sum("behind").alias("behind"))

    # terms of both, each two sources once: what the single corrections took for a baseline
    left, right = (shares.select("lang", "term", F.col("source").alias(f"{s}"), F.col("p").alias(f"{s}p"), F.col("base").alias(f"{s}b")) for s in "ab")
    ap, ab, bp, bb = (F.col(c) for c in ("ap", "ab", "bp", "bb"))
    both = left.join(right, ["lang", "term"]).where("a < b")
    fix = lambda p, pb, q, qb: gain(p, q) - gain(p, qb) - gain(pb, q) + gain(pb, qb)
    both = both.groupBy("lang", "a", "b").agg(F.sum(fix(ap, ab, bp, bb)).alias("forth"), F.sum(fix(bp, bb, ap, ab)).alias("back"))

    parts = [
        plain,
        single.select("lang", "source", "item", F.col("ahead").alias("value")),
        single.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("behind").alias("value")),
        both.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), F.col("forth").alias("value")),
        both.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), F.col("back").alias("value")),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole.groupBy("lang", "source", "item").agg(F.coalesce(F.sum("value"), F.lit(0)).cast("long").alias("value"))


def _bytes(number: Column, width: int) -> Column:
    return F.unhex(F.lpad(F.hex(number), 2 * width, "0"))


def sort_key(value: Column, item: Column) -> Column:
    """Bytes that order by value descending (0 or more), then by the item's UTF-8 ascending.

    The first two hold the number of bits and the ten bits behind the first, so
    that they tell values of any size apart.
    """
    bits = F.bin(value)
    lead = F.length(bits) * 1024 + F.conv(F.substring(F.rpad(bits, 11, "0"), 2, 10), 2, 10).cast("int")
    return F.concat(_bytes(F.lit(65535) - lead, 2), _bytes(F.lit(2**63 - 1) - value, 8), F.encode(item, "UTF-8"))


def _common(lo: Column, hi: Column) -> Column:
    """Number of bytes that two keys share at their start."""
    most = F.least(F.length(lo), F.length(hi))
    same = F.transform(F.when(most > 0, F.sequence(F.lit(1), most)).otherwise(F.array().cast("array<int>")), lambda i: F.substring(lo, i, F.lit(1)) == F.substring(hi, i, F.lit(1)))
    at = F.array_position(same, F.lit(False)).cast("int")
    return F.when(at > 0, at - 1).otherwise(most)


def radix_top(rows: DataFrame, by: list[str], k: int, slack: int = SLACK) -> DataFrame:
    """The ``k`` rows of each group ``by`` with the smallest ``key`` (bytes, different in a group), with ``rank``.

    ``rows`` is stored.  A pass reads the rows of groups still open and counts
    them by two bytes behind what their k-th row's neighbours share; it ends
    once every group has at most ``slack`` rows too many.
    """
    sizes = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("cnt"), F.min("key").alias("lo"), F.max("key").alias("hi"))
    state = durable(sizes.withColumn("need", F.lit(k).cast("long")), "radix-sizes")
    thresholds = None
    while True:
        # open: more rows share the boundary bytes than are needed, and too many to sort
        open_ = state.where(F.col("cnt") > F.col("need") + slack)
        closed = state.where(F.col("cnt") <= F.col("need") + slack).select(*by, F.col("hi").alias("last"))
        thresholds = closed if thresholds is None else thresholds.unionByName(closed)
        if open_.isEmpty():
            break
        inside = open_.select(*by, "need", F.substring("lo", F.lit(1), _common(F.col("lo"), F.col("hi"))).alias("prefix"))
        depth = F.length("prefix")
        met = rows.join(inside, by).where(F.substring("key", F.lit(1), depth) == F.col("prefix"))
        digits = met.groupBy(*by, "prefix", "need", F.substring("key", depth + 1, F.lit(_DIGIT)).alias("digit")).agg(F.count(F.lit(1)).alias("cnt"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        before = F.coalesce(F.sum("cnt").over(Window.partitionBy(*by).orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = digits.withColumn("_before", before).where((F.col("_before") < F.col("need")) & (F.col("_before") + F.col("cnt") >= F.col("need")))
        state = durable(placed.select(*by, (F.col("need") - F.col("_before")).alias("need"), "cnt", "lo", "hi"), "radix-pass")
    chosen = rows.join(thresholds, by).where(F.col("key") <= F.col("last")).drop("last")
    ranked = chosen.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("key")))
    return ranked.where(F.col("rank") <= k)


def audit(docs: DataFrame, least_docs: int = 3, k: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and the ``k`` terms
    of each source whose share exceeds the language's the most."""
    counts = durable(term_counts(docs), "divergence-counts")
    kept = durable(kept_terms(counts, least_docs), "divergence-kept")
    dealt = durable(counts.select(*GROUP, "term", "n").join(kept, ["lang", "term"]), "divergence-dealt")
    groups = durable(group_table(docs, dealt, kept), "divergence-groups")
    p, q = share(F.col("n"), F.col("total"), F.col("kinds")), share(F.col("lang_n"), F.col("lang_total"), F.col("kinds"))
    shares = durable(dealt.join(groups, GROUP).select(*GROUP, "term", "base", p.alias("p"), q.alias("q")), "divergence-shares")

    pairs = pair_values(shares.select(*GROUP, "term", "p", "base"), groups)
    ranks = F.row_number().over(Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item"))
    pairs = pairs.select(*GROUP, F.lit("pair").alias("part"), "item", "value", ranks.alias("rank"))

    value = gain(F.col("p"), F.col("q"))
    above = shares.where("p > q").select(*GROUP, F.col("term").alias("item"), value.alias("value"), sort_key(value, F.col("term")).alias("key"))
    terms = radix_top(durable(above, "divergence-above"), GROUP, k)
    return pairs.unionByName(terms.select(*GROUP, F.lit("term").alias("part"), "item", "value", "rank"))
