"""Token counts of whole texts with a library tokenizer.

Method: map-side two-tier lookup.  A pre-token is a run between the four ASCII
blanks that the tokenizer drops, so the count of a text is the sum of the
counts of its pre-tokens.  Tier one is a broadcast table of frequent
pre-tokens and their lengths; tier two is a bounded cache in each Python
worker, filled by encoding whatever tier one misses with the library itself.
The corpus is read once, in place: no pre-token of it is ever shuffled.

The broadcast table only saves time.  It comes from some ``sample_rows`` texts
(chosen by hash of the text: a mean, and a text that is very common is wholly
in or out; their pre-tokens are counted with map-side combining) and holds
``entries`` pre-tokens at most, so its size is bounded whatever the corpus;
results do not depend on it.

Defined results: a null or empty text has 0 tokens; repeated rows are counted
each; other columns pass through, and one named as the output gives way to it.
Very long pre-tokens are encoded, not cached.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_SLICE = 1024
_JOINED = 256
_CACHED_CHARS = 64
_worker: dict = {}


def pretokens(text: str) -> list[str]:
    """Split at ASCII blanks only: other white space is left to the library."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def load_tokenizer(serialized: str):
    """A single-threaded tokenizer from its JSON text."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(serialized)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _lengths(tokenizer, words: list[str]) -> list[int]:
    """Tokens of each pre-token, encoded many to a text and told apart by offset."""
    counts: list[int] = []
    for at in range(0, len(words), _JOINED):
        part = words[at : at + _JOINED]
        starts = np.cumsum([0, *(len(w) + 1 for w in part[:-1])])
        ends = [o[0] for o in tokenizer.encode(" ".join(part), add_special_tokens=False).offsets]
        counts += np.bincount(np.searchsorted(starts, ends, "right") - 1, minlength=len(part)).tolist()
    return counts


def frequent_lengths(docs: DataFrame, text_col: str, tokenizer, sample_rows: int, entries: int) -> dict[str, int]:
    """Lengths of the pre-tokens most frequent in a bounded sample of texts."""
    step = max(1, -(-docs.count() // sample_rows))
    sample = docs.select(F.col(text_col).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(step)) == 0)
    top = (
        sample.select(F.explode(F.split(F.translate("text", "\n\t\r", "   "), " ")).alias("word"))
        .where((F.length("word") > 0) & (F.length("word") <= _CACHED_CHARS))
        .groupBy("word")
        .count()
        .where("count > 1")
        .orderBy(F.desc("count"), "word")
        .limit(entries)
    )
    found = [r.word for r in top.select("word").collect()]
    return dict(zip(found, _lengths(tokenizer, found)))


class _Tiers(dict):
    """Tier one, with the worker's cache behind it."""

    second: dict[str, int]

    def __missing__(self, word: str) -> int:
        return self.second[word]


class _Counter:
    """Both tiers; one object for each Python worker and tokenizer."""

    def __init__(self, serialized: str, table: dict[str, int], cache_entries: int):
        self.tokenizer = load_tokenizer(serialized)
        self.first, self.limit = _Tiers({"": 0, **table}), cache_entries
        self.young, self.old = {}, {}

    def count(self, texts: list[str]) -> list[int]:
        split = [pretokens(t) for t in texts]
        new = set().union(*split).difference(self.first, self.young)
        if len(self.young) + len(new) > self.limit:  # two generations: what was not met since goes
            self.old, self.young = self.young, {}
            new = set().union(*split).difference(self.first)
        young, old = self.young, self.old
        young.update((w, old[w]) for w in new.intersection(old))
        misses = list(new.difference(old))
        young.update(zip(misses, _lengths(self.tokenizer, misses)))
        self.first.second = young
        counts = [sum(map(self.first.__getitem__, ws)) for ws in split]
        for w in misses:
            if len(w) > _CACHED_CHARS:
                del young[w]
        return counts


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    text_col: str = "text",
    out_col: str = "n_tokens",
    sample_rows: int = 2000,
    entries: int = 50_000,
    cache_entries: int = 300_000,
) -> DataFrame:
    """``docs`` with the token count of ``text_col`` instead of the text.

    ``tokenizer_path`` is a file of the tokenizers library, read on the driver
    and broadcast (its size does not depend on the data).
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as file:
        serialized = file.read()
    table = frequent_lengths(docs, text_col, load_tokenizer(serialized), sample_rows, entries)
    shared, key = spark.sparkContext.broadcast((serialized, table)), uuid.uuid4().hex
    kept = [c for c in docs.columns if c not in (text_col, out_col)]
    schema = docs.select(*kept).withColumn(out_col, F.lit(0).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _worker:
            _worker.clear()
            _worker[key] = _Counter(*shared.value, cache_entries)
        counter = _worker[key]
        for batch in batches:
            counts: list[int] = []
            column = batch.column(batch.schema.get_field_index(text_col))
            for at in range(0, len(column), _SLICE):
                counts += counter.count([t or "" for t in column.slice(at, _SLICE).to_pylist()])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], [*kept, out_col])

    return docs.mapInArrow(run, schema)
