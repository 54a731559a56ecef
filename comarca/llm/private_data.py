"""Personal data in whole texts, with DataFrame functions only.

Base patterns find plain addresses, network addresses, card numbers and
international phone numbers.  Method: candidate gradient boosting.  High-recall
generators propose spans that may overlap (:data:`GENERATORS`); boosted trees
judge each by its format and by the words around it; a threshold for each kind,
set on held-out rows, selects what is redacted.

The trees are fitted by ``pyspark.ml`` on a bounded sample: the
``sample_docs`` texts with a base span whose hash is smallest.  Their base
spans, written in other forms (:data:`FORMS`), are the rows with label 1; look-alikes made
from the same digits (:data:`LOOKALIKES`: dates, prices, versions, failed
checksums) and what the generators propose in the texts outside of base spans are
the rows with label 0.  The fitted trees become one column expression, so the
whole corpus is judged in a single map pass: no shuffle, no Python worker.

Positions come from ``split``: the pieces between the matches of a pattern and
the matches add up to the text.  Patterns are written so that a run of any
length is read once (possessive runs that begin at the run's start).

Defined results: null and empty texts have no spans; repeated rows are scanned
each; generators see the text without its base spans, and may overlap each
other; spans are in code points, end exclusive; where no text has a base span
there are no trees and no spans beyond the base.  Other columns pass through,
and those named as outputs give way to them.  The sample's order is by content,
so reruns agree.  Time is near to linear in a text, but redacting it takes the
text's length for each span.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from .common import durable
from .quality import let

_LOCAL, _LABEL = r"[A-Za-z0-9._%+-]", r"[A-Za-z0-9-]"
#: Base kinds in listed order, their patterns, and what a text with one has.
#: Each begins at the start of its run, or where the last match ended (\G).
BASE = {
    "email": (rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_LABEL}++(?:\.{_LABEL}++)++", rf"@{_LABEL}"),
    "ip": (r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]"),
    "card": (r"[0-9]++(?:[\x20-][0-9]++)*+", r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
}
#: Generators of further candidates, in listed order behind the base kinds.
GENERATORS = {
    "soft_email": (
        r"(?i)(?<![A-Z0-9._%+-])[A-Z0-9._%+-]{1,64}(?:@|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)[A-Z0-9-]{1,63}(?:(?:\.|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)[A-Z0-9-]{2,63}){1,6}",
        r"[\[({]\x20?(?i:at)\x20?[\])}]|\x20(?i:at)\x20[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]|\x20(?i:dot)\x20|\x20?[\[({]\x20?(?i:dot))",
    ),
    "soft_ip": (r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:.])", r":[0-9A-Fa-f]{0,4}:"),
    "soft_number": (r"(?<![0-9A-Za-z.,+])\(?[0-9](?:[\x20()./-]{0,3}[0-9]){6,18}(?![0-9A-Za-z]|[.,/-][0-9])", r"[0-9](?:[\x20()./-]{0,3}[0-9]){6}"),
    "soft_account": (r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![0-9A-Za-z])", r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}"),
}
KINDS = [*BASE, *GENERATORS]
#: Words that go with personal data, and words that go with other numbers.
PERSONAL = "call|phone|tel|mobile|cell|fax|contact|reach|mail|write|card|visa|account|iban|ssn|passport|id|address|host|client|customer|llam|correo|appel|anruf|telefon|konto|cuenta|compte"
IMPERSONAL = "version|release|order|invoice|page|chapter|isbn|issn|doi|license|build|section|row|item|figure|table|year|date|total|price|lines|bytes"
#: Code points before and behind a candidate that its features see.
CONTEXT = 24
_NEAR = 2  # of those, behind it


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of at most 19 digits has a right last digit."""
    turned = F.reverse(digits)
    places = [F.substring(turned, i, 1) for i in range(1, 20)]
    terms = [F.coalesce(F.try_to_number(F.translate(p, "0123456789", "0246813579") if i % 2 else p, F.lit("9")).cast("int"), F.lit(0)) for i, p in enumerate(places)]
    return reduce(lambda a, b: a + b, terms) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    """Whether a match of a base pattern counts."""
    if kind == "ip":
        parts = F.transform(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(parts, lambda p: F.when(F.length(p) <= 3, p.cast("int") <= 255).otherwise(False))
    if kind == "card":
        return let(_digits(value), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    return F.length(_digits(value)).between(10, 15) if kind == "phone" else F.lit(True)


def _sums_before(numbers: Column) -> Column:
    """For each number the sum of those before it, by chunks: near to linear."""
    chunk = 256
    every = F.when(F.size(numbers) > 0, F.sequence(F.lit(0), ((F.size(numbers) - 1) / chunk).cast("int"))).otherwise(F.array().cast("array<int>"))
    total = lambda ns: F.aggregate(ns, F.lit(0), lambda a, x: a + x)
    before = lambda ns: F.transform(ns, lambda _, i: total(F.slice(ns, 1, i)))

    def placed(chunks: Column) -> Column:
        starts = let(F.transform(chunks, total), before)
        return F.flatten(F.zip_with(chunks, starts, lambda ns, at: F.transform(before(ns), lambda x: x + at)))

    return let(F.transform(every, lambda c: F.slice(numbers, c * chunk + 1, chunk)), placed)


_NONE = "array<struct<s:int,e:int,value:string,before:string,behind:string>>"


def matches(text: Column, pattern: str, needs: str) -> Column:
    """Array of (s, e, value, before, behind) of the matches of ``pattern``, for texts with ``needs``.

    The words around a match are those of the piece between it and the next match.
    """
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)

    def placed(values: Column, between: Column) -> Column:
        ends = F.zip_with(values, F.slice(between, 1, F.size(values)), lambda v, g: F.length(g) + F.length(v))

        def one(at: Column, i: Column) -> Column:
            s = at + F.length(between[i])
            return F.struct(s.alias("s"), (s + F.length(values[i])).alias("e"), values[i].alias("value"), F.lower(F.right(between[i], F.lit(CONTEXT))).alias("before"), F.left(between[i + 1], F.lit(_NEAR)).alias("behind"))

        return F.transform(_sums_before(ends), one)

    return F.when(text.rlike(needs), let(found, lambda v: let(gaps, lambda g: placed(v, g)))).otherwise(F.array().cast(_NONE))


def _base_of(text: Column, kind: str) -> Column:
    passing = F.filter(matches(text, *BASE[kind]), lambda m: _passes(kind, m["value"]))
    rank = KINDS.index(kind)
    return F.transform(passing, lambda m: F.struct(m["s"].alias("s"), F.lit(rank).alias("rank"), m["e"].alias("e"), F.lit(kind).alias("kind")))


def base_spans(text: Column) -> Column:
    """Array of (s, rank, e, kind) of the base spans, by start and then kind."""
    return F.array_sort(F.concat(*(_base_of(text, kind) for kind in BASE)))


def _blanked(text: Column, kind: str) -> Column:
    pattern, needs = BASE[kind]

    def blank(values: Column, gaps: Column) -> Column:
        kept = F.zip_with(values, F.slice(gaps, 1, F.size(values)), lambda v, g: F.concat(g, F.when(_passes(kind, v), F.repeat(F.lit("\0"), F.length(v))).otherwise(v)))
        return F.concat(F.array_join(kept, ""), F.element_at(gaps, -1))

    cut = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: let(F.split(text, pattern, -1), lambda g: blank(v, g)))
    return F.when(text.rlike(needs), cut).otherwise(text)


def without_base(text: Column) -> Column:
    """The text with its base spans overwritten by as many NULs, kind after kind."""
    return reduce(lambda t, kind: let(t, lambda x: _blanked(x, kind)), BASE, text)


def _proposed(text: Column, kind: str) -> Column:
    fields = ("s", "e", "value", "before", "behind")
    return F.transform(matches(text, *GENERATORS[kind]), lambda m: F.struct(F.lit(kind).alias("kind"), *(m[c].alias(c) for c in fields)))


def candidates(text: Column) -> Column:
    """Array of (kind, s, e, value, before, behind): all that the generators propose beside the base spans."""
    return let(without_base(text), lambda t: F.concat(*(_proposed(t, kind) for kind in GENERATORS)))


def features(c: Callable[[str], Column]) -> dict[str, Column]:
    """Format and context of a candidate; ``c`` gives its fields."""
    value, before, behind = c("value"), c("before"), c("behind")
    digits = _digits(value)
    groups = F.array_remove(F.split(value, "[^0-9]+", -1), "")

    def has(pattern: str, where: Column = value) -> Column:
        return where.rlike(pattern).cast("double")

    return {
        **{f"is_{k}": (c("kind") == k).cast("double") for k in GENERATORS},
        "length": F.length(value).cast("double"),
        "digits": F.length(digits).cast("double"),
        "groups": F.size(groups).cast("double"),
        "longest": F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)).cast("double"),
        "letters": F.length(F.regexp_replace(value, r"[^\p{L}]", "")).cast("double"),
        "parenthesis": has(r"\("),
        "dot": has(r"\."),
        "slash": has("/"),
        "hyphen": has("-"),
        "blank": has(" "),
        "threes": has(r"^\(?[0-9]{3}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-]?[0-9]{4}$"),
        "identity": has(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "fours": has(r"^(?:[0-9]{4}[\x20./-]){3}[0-9]{1,7}$"),
        "checksum": F.when(F.length(digits).between(14, 19), luhn(digits).cast("double")).otherwise(0.0),
        "date": has(r"(?<![0-9])(?:19|20)[0-9]{2}(?![0-9])|^[0-3]?[0-9][./-][0-3]?[0-9][./-]"),
        "same": has(r"^\D*([0-9])(?:\D*\1)*\D*$"),
        "domain": has(r"(?i)(?:\.|dot[\])}]?\x20?)(?:com|org|net|edu|gov|info|io|co|de|es|fr|uk|eu|example|test)$"),
        "spelled": has(r"(?i)[\[({]\x20?at"),
        "colons": F.length(F.regexp_replace(value, "[^:]", "")).cast("double"),
        "personal": has(rf"\b(?:{PERSONAL})", before),
        "impersonal": has(rf"\b(?:{IMPERSONAL})", before),
        "money": has(r"[$€£#]\s?$", before),
        "unit": has(r"^\s?[%€$£]|^\s?[kmg]b", behind),
    }


#: Other forms of a base span: (base kind, generator that proposes it, how it is written).
FORMS: list[tuple[str, str, Callable[[Column], Column]]] = [
    ("email", "soft_email", lambda v: F.regexp_replace(v, "@", " at ")),
    ("email", "soft_email", lambda v: F.replace(F.regexp_replace(v, "@", " (at) "), F.lit("."), F.lit(" dot "))),
    ("email", "soft_email", lambda v: F.replace(F.regexp_replace(v, "@", "[at]"), F.lit("."), F.lit("[dot]"))),
    ("phone", "soft_number", lambda v: F.regexp_replace(v, r"^\+[0-9]{1,3}[\x20.-]?", "")),
    ("phone", "soft_number", lambda v: F.regexp_replace(F.substring(_digits(v), -10, 10), r"^([0-9]{3})([0-9]{3})", "$1-$2-")),
    ("phone", "soft_number", lambda v: F.regexp_replace(F.substring(_digits(v), -10, 10), r"^([0-9]{3})([0-9]{3})", "$1.$2.")),
    ("phone", "soft_number", lambda v: F.regexp_replace(F.substring(_digits(v), -10, 10), r"^([0-9]{3})([0-9]{3})", "($1) $2 ")),
    ("phone", "soft_number", lambda v: F.regexp_replace(F.substring(_digits(v), -9, 9), r"^([0-9]{3})([0-9]{2})", "$1-$2-")),
    ("card", "soft_number", lambda v: F.regexp_replace(_digits(v), "([0-9]{4})(?=[0-9])", "$1.")),
    ("card", "soft_number", lambda v: F.regexp_replace(_digits(v), "([0-9]{4})(?=[0-9])", "$1/")),
    ("card", "soft_account", lambda v: F.regexp_replace(F.concat(F.lit("DE"), _digits(v), F.lit("0042")), "([A-Z0-9]{4})(?=[A-Z0-9])", "$1 ")),
    ("card", "soft_account", lambda v: F.concat(F.lit("ES"), _digits(v), F.lit("731902"))),
    ("ip", "soft_ip", lambda v: F.concat(F.lit("2001:db8:"), F.replace(v, F.lit("."), F.lit(":")))),
    ("ip", "soft_ip", lambda v: F.concat(F.lit("fe80::"), F.regexp_replace(v, r"^([0-9]+)\.([0-9]+)\..*$", "$1:$2"))),
]
#: What looks like a base span in another form and is none.
LOOKALIKES: list[tuple[str, str, Callable[[Column], Column]]] = [
    ("email", "soft_email", lambda v: F.concat(F.lit("arrive at "), F.regexp_extract(v, "[0-9]+", 0), F.lit(".30"))),
    ("email", "soft_email", lambda v: F.concat(F.lit("look at section."), F.regexp_extract(v, "[0-9]+", 0))),
    ("phone", "soft_number", lambda v: F.concat(F.lit("20"), F.regexp_replace(F.substring(_digits(v), -6, 6), "^([0-9]{2})[0-9]([0-9])[0-9]([0-9])$", "$1-0$2-1$3"))),
    ("phone", "soft_number", lambda v: F.concat(F.lit("1"), F.substring(_digits(v), -1, 1), F.lit("/0"), F.substring(_digits(v), -2, 1), F.lit("/19"), F.substring(_digits(v), -4, 2))),
    ("phone", "soft_number", lambda v: F.concat(F.lit("20"), F.substring(_digits(v), -4, 2), F.lit("-20"), F.substring(_digits(v), -2, 2))),
    ("phone", "soft_number", lambda v: F.substring(_digits(v), -8, 8)),
    ("phone", "soft_number", lambda v: F.concat(F.substring(_digits(v), -6, 2), F.lit("."), F.substring(_digits(v), -4, 1), F.lit("."), F.substring(_digits(v), -9, 4))),
    ("card", "soft_number", lambda v: F.translate(_digits(v), "0123456789", "1325476980")),
    ("card", "soft_number", lambda v: F.substring(_digits(v), 1, 12)),
    ("card", "soft_number", lambda v: F.regexp_replace(F.substring(_digits(v), 1, 13), r"^([0-9]{3})([0-9])([0-9]{5})", "$1-$2-$3-")),
    ("ip", "soft_ip", lambda v: F.regexp_replace(v, r"^([0-9]?)[0-9]*\.([0-9])[0-9]*\.([0-9])[0-9]*\..*$", "1$1:4$2:3$3")),
    ("ip", "soft_number", lambda v: F.concat(v, F.lit("."), F.substring(_digits(v), 1, 2))),
    ("card", "soft_account", lambda v: F.concat(F.lit("AB"), F.substring(_digits(v), 1, 10))),
    ("card", "soft_account", lambda v: F.concat(F.lit("NO20"), F.substring(_digits(v), 1, 8))),
]


@dataclass(frozen=True)
class Leaf:
    value: float


@dataclass(frozen=True)
class Split:
    feature: int
    at: float
    low: Leaf | Split
    high: Leaf | Split


@dataclass(frozen=True)
class Model:
    """Boosted trees with weights, and the least score of each generator that is redacted."""

    trees: tuple[tuple[float, Leaf | Split], ...]
    least: dict[str, float]
    names: tuple[str, ...]

    def score(self, given: dict[str, Column]) -> Column:
        """Probability of a candidate from the trees' weighted sum."""
        def value(node: Leaf | Split) -> Column:
            if isinstance(node, Leaf):
                return F.lit(node.value)
            return F.when(given[self.names[node.feature]] <= node.at, value(node.low)).otherwise(value(node.high))

        total = reduce(lambda a, b: a + b, (F.lit(w) * value(t) for w, t in self.trees))
        return 1 / (1 + F.exp(-2 * total))


def _tree(node) -> Leaf | Split:
    """A fitted tree as plain nodes (the model's own classes live in the JVM)."""
    if node.numDescendants() == 0:
        return Leaf(node.prediction())
    split = node.split()
    return Split(split.featureIndex(), split.threshold(), _tree(node.leftChild()), _tree(node.rightChild()))


def labelled_rows(docs: DataFrame, text_col: str = "text", sample_docs: int = 600) -> DataFrame:
    """(kind, value, before, behind, label, fold): of ``sample_docs`` texts with base spans.

    ``fold`` is 0 to 4 by the text's hash; rows of a text share it.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    likely = reduce(lambda a, b: a | b, (text.rlike(needs) for _, needs in BASE.values()))
    texts = docs.select(text.alias("text")).where(likely).select("text", F.xxhash64("text").alias("h"))
    texts = durable(texts.orderBy("h", "text").limit(sample_docs), "private-sample").coalesce(1).sortWithinPartitions("h", "text")
    spans = texts.select("text", "h", F.posexplode(base_spans(F.col("text"))).alias("i", "b"))
    spans = spans.select("h", "i", F.col("b.kind").alias("base"), F.substring(F.col("text"), F.col("b.s") + 1, F.col("b.e") - F.col("b.s")).alias("v"), F.lower(F.substring(F.col("text"), F.greatest(F.col("b.s") - CONTEXT, F.lit(0)) + 1, F.least(F.col("b.s"), F.lit(CONTEXT)))).alias("before"), F.substring(F.col("text"), F.col("b.e") + 1, F.lit(_NEAR)).alias("behind"))

    def written(forms: Sequence[tuple], label: float) -> Column:
        # every third has a word of its class in front, as texts in the wild often do
        hints = F.split(F.lit(PERSONAL if label else IMPERSONAL), r"\|")
        made = [F.struct(F.lit(base).alias("base"), F.lit(kind).alias("kind"), form(F.col("v")).alias("value"), F.lit(label).alias("label"), (F.lit(n) + F.pmod("h", F.lit(997)).cast("int")).alias("turn")) for n, (base, kind, form) in enumerate(forms)]
        rows = F.filter(F.array(*made), lambda x: x["base"] == F.col("base"))
        hinted = lambda x: F.when(x["turn"] % 3 == 0, F.concat(F.get(hints, x["turn"] % F.size(hints)), F.lit(" "))).otherwise(F.col("before"))
        return F.transform(rows, lambda x: F.struct(x["kind"].alias("kind"), x["value"].alias("value"), hinted(x).alias("before"), F.col("behind"), x["label"].alias("label")))

    made = spans.select("h", F.explode(F.concat(written(FORMS, 1.0), written(LOOKALIKES, 0.0))).alias("r")).select("h", "r.*")
    outside = texts.select("h", F.explode(candidates(F.col("text"))).alias("c"))
    outside = outside.select("h", "c.kind", "c.value", "c.before", "c.behind", F.lit(0.0).alias("label"))
    return made.unionByName(outside).withColumn("fold", F.pmod("h", F.lit(5)).cast("int")).drop("h")


def fit(docs: DataFrame, text_col: str = "text", sample_docs: int = 600, trees: int = 12, depth: int = 4, least_precision: float = 0.98) -> Model | None:
    """Trees from labelled rows of folds 1 to 4, thresholds from fold 0; None without both labels.

    A generator's threshold is the least score, 0.5 at least, from which on
    ``least_precision`` of the held-out rows have label 1; without held-out rows
    of label 1 its candidates are not redacted.
    """
    rows = labelled_rows(docs, text_col, sample_docs)
    made = durable(rows.select("kind", "label", "fold", *(c.alias(n) for n, c in features(F.col).items())), "private-rows").coalesce(1)
    names = [n for n in made.columns if n not in ("kind", "label", "fold")]
    made = made.sortWithinPartitions("fold", "kind", "label", *names)  # reruns see one order
    learning = made.where("fold <> 0")
    if learning.select("label").distinct().count() < 2:
        return None
    packed = VectorAssembler(inputCols=names, outputCol="features").transform(learning)
    fitted = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=0.3, seed=7, maxBins=48).fit(packed)
    grown = tuple((w, _tree(t._call_java("rootNode"))) for w, t in zip(fitted.treeWeights, fitted.trees))
    model = Model(grown, {}, tuple(names))
    held = made.where("fold = 0").select("kind", "label", model.score({n: F.col(n) for n in names}).alias("score"))
    return Model(grown, thresholds(held.collect(), least_precision), tuple(names))  # a bounded sample's rows


def thresholds(held: Sequence, least_precision: float) -> dict[str, float]:
    """Least score of each kind from which on the held-out rows are right often enough."""
    out = {}
    for kind in GENERATORS:
        scored = sorted(((r.score, r.label) for r in held if r.kind == kind), reverse=True)
        right, seen = 0.0, 0
        for i, (score, label) in enumerate(scored):
            right, seen = right + label, seen + 1
            last_of_ties = i + 1 == len(scored) or scored[i + 1][0] < score
            if last_of_ties and score >= 0.5 and right >= least_precision * seen:
                out[kind] = score
    return out


def added_spans(text: Column, model: Model) -> Column:
    """Array of (s, rank, e, kind): candidates that reach the threshold of their generator."""
    ranks = {k: i for i, k in enumerate(KINDS)}

    def judged(c: Column) -> Column:
        least = reduce(lambda other, k: F.when(c["kind"] == k, F.lit(model.least[k])).otherwise(other), model.least, F.lit(2.0))
        described = F.struct(*(v.alias(n) for n, v in features(lambda name: c[name]).items()))
        return let(described, lambda f: model.score({n: f[n] for n in model.names})) >= least

    def ranked(c: Column) -> Column:
        rank = reduce(lambda other, k: F.when(c["kind"] == k, F.lit(ranks[k])).otherwise(other), GENERATORS, F.lit(-1))
        return F.struct(c["s"].alias("s"), rank.alias("rank"), c["e"].alias("e"), c["kind"].alias("kind"))

    return F.transform(F.filter(candidates(text), judged), ranked)


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda span: span["kind"] == kind


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlaps go once."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(state: Column, x: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, F.greatest(x["s"] - state["at"], F.lit(0)))
        put = F.when(x["s"] >= state["at"], F.concat(state["out"], F.array(gap, F.concat(F.lit("["), x["kind"], F.lit("]"))))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], x["e"]).alias("at"), put.alias("out"))

    done = F.aggregate(spans, start, step, lambda s: F.array_append(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, F.array_join(done, "")).otherwise(text)


def scan(docs: DataFrame, text_col: str = "text", model: Model | None = None, redact: bool = False) -> DataFrame:
    """``docs`` with counts of base spans, ``base_sha256`` and ``spans`` instead of the text.

    Without a model only the base patterns work.  With ``redact`` the text
    stays, its spans replaced by their kinds.
    """
    text_name = "_text"
    while text_name in docs.columns:
        text_name += "_"
    outputs = [*(f"n_{k}" for k in BASE), "base_sha256", "spans"]
    given = docs.drop(*(c for c in outputs if c != text_col)).withColumn(text_name, F.coalesce(F.col(text_col), F.lit(""))).drop(text_col)
    text = F.col(text_name)

    def made(base: Column) -> Column:
        every = base if model is None else F.array_sort(F.concat(base, added_spans(text, model)))
        counts = [F.size(F.filter(base, _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
        text_out = [redacted(text, every).alias(text_col)] if redact else []
        return F.struct(*counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(every).alias("spans"), *text_out)

    # a generator: filters on the outcome stay above it and compute nothing again
    return given.select("*", F.inline(F.array(let(base_spans(text), made)))).drop(text_name)
