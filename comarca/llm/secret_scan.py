"""Secret scans of whole texts.

Base patterns find assigned credentials, access keys and long hex runs.
Method: password guess-cost dynamic programming.  Values in a credential
context that no base span covers whole are cut into words, dates, repeats, keyboard
walks and brute-force spans at the least total cost; a value whose cheapest
cut still takes 10**``least_cost`` guesses or more is a secret too.

A text is scanned in one piece, on its own: no shuffle, and nothing kept
between rows.

Defined results: null and empty texts have no spans; repeated rows are scanned
each; spans are in code points, end exclusive; other columns pass through, and
those named as outputs give way to them.
"""

from __future__ import annotations

import functools
import hashlib
import json
import math
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

_SLICE = 512
#: The base patterns; the least length of the judged part.
BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]{24,}"), 0, 24),
)
GUESS = "guess"
_ORDER = {kind: i for i, (kind, *_) in enumerate(BASE)} | {GUESS: len(BASE)}
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "bearer")
_CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|secret)[\x20_-]?key|credentials?)["'\])]{0,2}(?:\x20{0,4}(?:[:=]{1,2}>?|->)|\x20is)\x20{0,4}["'`]?([^\s"'`,;<>]{8,})|bearer\x20([^\s"'`,;<>]{8,})""",
    re.I | re.A,
)
#: The commonest passwords and their words, commonest first; the ranked list of :func:`word_ranks` follows.
COMMON = (
    "password passw0rd pass secret token admin root user login welcome letmein monkey dragon master qwerty abc iloveyou "
    "princess sunshine shadow football baseball superman batman trustno1 hello freedom whatever test guest default "
    "changeme access server system database example sample demo key private public home love summer winter spring "
    "autumn monday friday january march april june july august october december mother father sister brother money "
    "computer internet google company office manager service support the and for you with this that from have not"
).split()
#: Words of two letters; the list's own are mostly fragments.
_SHORT = frozenset("am an as at be by do go he if in is it me my no of on or so to up us we".split())
#: Longer words are not looked up, so a place has a bounded number of spans.
LONGEST_WORD = 20
_JOINS = "-_./"
_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm", "abcdefghijklmnopqrstuvwxyz", "0123456789", "1qaz", "2wsx", "3edc", "4rfv", "5tgb", "6yhn", "7ujm")
_WALKS = tuple(r for row in _ROWS for r in (row, row[::-1]))
_DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")
_LEET = str.maketrans("@4301$57!", "aaeoissti")


@functools.cache
def word_ranks() -> dict[str, int]:
    """Guess ranks of words: ``COMMON``, then the whole words of the public word vocabulary, in its order of frequency.

    Some 30,000 entries whatever the data.
    """
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocab = json.load(file)["model"]["vocab"]
    whole = (w[:-4] for w in sorted(vocab, key=vocab.get) if re.fullmatch(r"[a-z]{2,}</w>", w))
    listed_ = dict.fromkeys([*COMMON, *(w for w in whole if len(w) > 2 or w in _SHORT)])
    return {w: i + 1 for i, w in enumerate(listed_)}


def _alphabet(value: str) -> int:
    """Size of the character classes a value draws on."""
    sizes = ((r"[a-z]", 26), (r"[A-Z]", 26), (r"[0-9]", 10), (r"[^A-Za-z0-9]", 33))
    return sum(n for pattern, n in sizes if re.search(pattern, value))


class _Spans:
    """The priced spans of a value: (end, log10 of guesses) of those that start at a place."""

    def __init__(self, value: str, ranks: dict[str, int]):
        self.value, self.lower, self.ranks = value, value.lower(), ranks
        self.plain = self.lower.translate(_LEET)
        self.per_char = math.log10(max(10, _alphabet(value)))
        self.same = {unit: self._repeats(unit) for unit in (1, 2, 3, 4)}

    def _repeats(self, unit: int) -> list[int]:
        """How far the value repeats itself, ``unit`` characters on, from each place."""
        value, length = self.value, [0] * (len(self.value) + 1)
        for i in range(len(value) - unit - 1, -1, -1):
            length[i] = length[i + 1] + 1 if value[i] == value[i + unit] else 0
        return length

    def at(self, i: int) -> Iterator[tuple[int, float]]:
        value, lower, n = self.value, self.lower, len(self.value)
        yield i + 1, self.per_char  # brute force, a character at a time
        if value[i] in _JOINS and value[i - 1 : i].isalpha() and value[i + 1 : i + 2].isalpha():
            yield i + 1, math.log10(len(_JOINS) + 1)  # a hyphen or its like between words
        for j in range(i + 2, min(n, i + LONGEST_WORD) + 1):
            for text, extra in ((lower[i:j], 0.0), (self.plain[i:j], 0.5)):
                if text in self.ranks:
                    yield j, math.log10(self.ranks[text] + 1) + extra + (0.0 if value[i:j].islower() else 0.5)
        if m := _DATE.match(value, i):
            yield m.end(), math.log10(365 * 120)
        run = 1 + self.same[1][i]
        if run >= 3:
            yield i + run, self.per_char + math.log10(run)
        for walk in _WALKS:
            at, k = walk.find(lower[i]), 0
            while at >= 0 and i + k < n and at + k < len(walk) and walk[at + k] == lower[i + k]:
                k += 1
            if k >= 3:
                yield i + k, math.log10(len(_WALKS) * 10) + math.log10(k)
        for unit in (2, 3, 4):  # a repeated unit costs its first copy and a count
            copies = 1 + self.same[unit][i] // unit
            if copies >= 2:
                yield i + unit * copies, unit * self.per_char + math.log10(copies)


def guess_cost(value: str, ranks: dict[str, int] | None = None, enough: float = math.inf) -> float:
    """Log10 of the guesses for the cheapest cut of ``value``.

    Spans have bounded length or are runs, so time is linear in the value.
    Once every cut is sure to cost ``enough`` (looked at whenever the place has
    doubled), a bound that is at least that is returned.
    """
    spans, n = _Spans(value, ranks or word_ranks()), len(value)
    best = [0.0] + [math.inf] * n
    for i in range(n):
        for j, cost in spans.at(i):
            best[j] = min(best[j], best[i] + cost)
        if i >= 64 and i & (i - 1) == 0 and (bound := min(best[i + 1 :])) >= enough:
            return bound
    return best[n]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans, by start and then kind as listed."""
    found = []
    low = text.lower()
    for kind, pattern, group, least in BASE:
        if kind == "assign" and not any(h in low for h in _ASSIGN_HINTS) or kind == "access" and "AKIA" not in text:
            continue
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if len(m[group]) >= least]
    return sorted(found, key=lambda s: (s[1], _ORDER[s[0]]))


def guessed_spans(text: str, base: list[tuple[str, int, int]], least_cost: float, ranks: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """Values in a credential context that are dear to guess and that no base span covers whole."""
    low = text.lower()
    if not any(h in low for h in _HINTS):
        return []
    found = []
    for m in _CONTEXT.finditer(text):
        start, end = m.span(1) if m[1] else m.span(2)
        while end > start and text[end - 1] in ".)]}!?:":
            end -= 1
        value = text[start:end]
        if len(value) < 8 or any(s <= start and end <= e for _, s, e in base):
            continue
        if guess_cost(value, ranks, least_cost) >= least_cost:
            found.append((GUESS, start, end))
    return found


def listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; overlaps go once."""
    out, at = [], 0
    for kind, start, end in spans:
        if end <= at:
            continue
        out += [text[at : max(at, start)], f"[{kind}]"] if start >= at else []
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, text_col: str = "text", least_cost: float = 9.0, redact: bool = False) -> DataFrame:
    """``docs`` with counts, ``base_sha256`` and ``spans`` instead of the text.

    With ``redact`` the text stays, its spans replaced by their kinds.
    """
    counts = [f"n_{kind}" for kind, *_ in BASE]
    kept = [c for c in docs.columns if c not in (text_col, *counts, "base_sha256", "spans")]
    out = [*(T.StructField(c, T.LongType()) for c in counts), T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    schema = T.StructType([*docs.select(*kept).schema.fields, *out, *([T.StructField(text_col, T.StringType())] if redact else [])])

    shared = docs.sparkSession.sparkContext.broadcast(word_ranks())

    def one(text: str) -> list:
        base = base_spans(text)
        spans = sorted([*base, *guessed_spans(text, base, least_cost, shared.value)], key=lambda s: (s[1], _ORDER[s[0]]))
        row = [*(sum(k == kind for k, *_ in base) for kind, *_ in BASE), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans)]
        return [*row, redacted(text, spans)] if redact else row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                rows = [one(t or "") for t in part.column(part.schema.get_field_index(text_col)).to_pylist()]
                kinds = [*[pa.int64()] * len(counts), pa.string(), pa.string(), *([pa.string()] if redact else [])]
                made = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), *made], schema.names)

    return docs.mapInArrow(run, schema)
