"""Spelling variants: words one edit apart, the commoner form of each, and its root.

Method: forward and backward minimal acyclic automata with perfect-hash word
numbers.  A word meets another one edit away if its first half stays as it is
and the edit lies behind it, or if its second half stays and the edit lies
before it.  So each word walks its first half through an automaton of the
words and completes with one error; the same is done with all words reversed;
what both find is counted once.  A pair is looked for from one side only, the
shorter word's or, of equal lengths, from the word with the smaller letter at
the difference, and given to both.

No automaton holds the whole vocabulary.  The words are put in order and cut
into blocks of ``BLOCK_WORDS`` words and ``BLOCK_CHARS`` code points (beyond
one longest word); a word goes to the blocks whose range holds words with its
half, so a beginning that a third of all words share fills many blocks and no
task holds more than one at a time.  The word's number in a block is the
automaton's perfect hash.  What every task knows is the first word of each
block, cut to 64 code points.

Roots follow forms by pointer doubling: a form is ``ratio`` times as frequent
as its word, so a chain is no longer than a logarithm of the largest count.

Defined results: null and empty texts have no words; a null id counts as '';
repeated rows count each; an empty table gives no rows; ties of frequency go to
the smaller word in code-point order.  Columns beyond those named are not read,
so their names cannot clash.  A very long run is one word; memory is some 200
bytes for each code point of a block.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import durable, lower_ascii_text

#: A letter of a run, in lower case but for the letters beyond ASCII.
LETTERS = r"[a-zÀ-ÿ]"
BLOCK_WORDS = 20_000
BLOCK_CHARS = 1_000_000
#: Blocks at most, whatever the vocabulary; they get longer beyond it.
MOST_BLOCKS = 1 << 16
#: Code points of a block's first word that every task knows.
_KNOWN = 64
_BATCH = 20_000


class Automaton:
    """Minimal acyclic automaton of sorted, distinct words that numbers them from 0."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, tuple[int, int]]] = []
        self.final: list[bool] = []
        self._count: list[int] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[list[bool], list]] = [([False], [])]
        before = ""
        for word in words:
            same, most = 0, min(len(word), len(before))
            while same < most and word[same] == before[same]:
                same += 1
            self._close(path, before, same)
            path += [([False], []) for _ in range(len(word) - same)]
            path[-1][0][0] = True
            before = word
        self._close(path, before, 0)
        self.root = self._frozen(path[0])
        del self._known

    def _close(self, path: list, word: str, depth: int) -> None:
        """Freeze the states of ``word`` below ``depth``, the deepest first."""
        while len(path) > depth + 1:
            state = self._frozen(path.pop())
            path[-1][1].append((word[len(path) - 1], state))

    def _frozen(self, node: tuple[list[bool], list]) -> int:
        final, out = node[0][0], tuple(node[1])
        state = self._known.get((final, out))
        if state is None:
            state, skipped, edges = len(self.edges), int(final), {}
            for letter, target in out:
                edges[letter] = (target, skipped)
                skipped += self._count[target]
            self._known[final, out] = state
            self.edges.append(edges)
            self.final.append(final)
            self._count.append(skipped)
        return state

    def _end(self, state: int, word: str, at: int, number: int) -> int:
        """Number of the word that goes on from ``state`` by ``word[at:]``; -1 without one."""
        edges = self.edges
        for letter in word[at:] if at else word:
            step = edges[state].get(letter)
            if step is None:
                return -1
            state = step[0]
            number += step[1]
        return number if self.final[state] else -1

    def number(self, word: str) -> int:
        """Perfect-hash number of a word; -1 for others."""
        return self._end(self.root, word, 0, 0)

    def one_error(self, word: str, exact: int) -> set[int]:
        """Numbers of words with the first ``exact`` letters of ``word`` that differ
        by one inserted letter, or by one letter that is larger than the word's."""
        edges, state, number, found = self.edges, self.root, 0, set()
        for letter in word[:exact]:
            step = edges[state].get(letter)
            if step is None:
                return found
            state = step[0]
            number += step[1]
        n, end = len(word), self._end
        for at in range(exact, n):
            letter, out = word[at], edges[state]
            after = word[at + 1] if at + 1 < n else None
            for other, (target, skipped) in out.items():
                ahead = edges[target]
                if letter in ahead and (hit := end(target, word, at, number + skipped)) >= 0:
                    found.add(hit)
                if other > letter and (after is None or after in ahead) and (hit := end(target, word, at + 1, number + skipped)) >= 0:
                    found.add(hit)
            step = out.get(letter)
            if step is None:
                return found
            state = step[0]
            number += step[1]
        for target, skipped in edges[state].values():
            if self.final[target]:
                found.add(number + skipped)
        return found


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = 6, least_count: int = 5, typo_every: int | None = None) -> DataFrame:
    """(word, n): runs of letters of whole texts with their occurrences.

    With ``typo_every`` a run whose crc32 of ``<id>:<run>`` it divides loses the
    code point at crc32 % length: a known share of misspellings to find again.
    """
    text = lower_ascii_text(F.coalesce(F.col(text_col), F.lit("")))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(text, F.lit(f"{LETTERS}{{{least_length},}}"), F.lit(0))).alias("word"))
    if typo_every is not None:
        hashed = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word")))
        place = (F.col("h") % F.length("word")).cast("int")
        rest = F.substr("word", place + 2, F.length("word"))
        runs = hashed.withColumn("word", F.when(F.col("h") % typo_every == 0, F.concat(F.substr("word", F.lit(1), place), rest)).otherwise(F.col("word")))
    counted = runs.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least_count)


def _numbered(block_words: int, block_chars: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to sorted rows ``place`` (in order over all tasks) and ``block``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        place, block, held, chars = task << 33, task << 20, 0, 0
        for batch in batches:
            blocks = []
            for key in batch.column(batch.schema.get_field_index("key")).to_pylist():
                if held and (held >= block_words or chars + len(key) > block_chars):
                    block, held, chars = block + 1, 0, 0
                held, chars = held + 1, chars + len(key)
                blocks.append(block)
            places = pa.array(range(place, place + batch.num_rows), pa.int64())
            place += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, places, pa.array(blocks, pa.int64())], [*batch.schema.names, "place", "block"])

    return run


def _dealt(starts: list[str], blocks: list[int], backward: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each word to its own block, and as a query to the blocks that may hold its half."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for key, number, n, block in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "id", "n", "block"))):
                out.append((block, 0, key, number, n))
                half = key[: len(key) - len(key) // 2 if backward else len(key) // 2]
                i = bisect_left(starts, half) - 1
                if i >= 0 and len(starts[i]) == _KNOWN:  # blocks of equal cut starts: from before the first
                    i = bisect_left(starts, starts[i]) - 1
                i = max(0, i)
                while i < len(starts) and (starts[i] <= half or starts[i].startswith(half)):
                    out.append((blocks[i], 1, key, number, n))
                    i += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), _DEALT_KINDS)] if out else [pa.array([], k) for k in _DEALT_KINDS], _DEALT)

    return run


_DEALT = ["block", "role", "key", "id", "n"]
_DEALT_KINDS = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64())
_PAIR = ["id", "near_id", "near_n"]


def _matched(backward: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Pairs of a task's blocks, one block after the other: the words first, then the queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, words, ids, counts, automaton = None, [], [], [], None
        out: tuple[list, list, list] = ([], [], [])
        for batch in batches:
            for block, role, key, number, n in zip(*(c.to_pylist() for c in batch.columns)):
                if block != now:
                    now, words, ids, counts, automaton = block, [], [], [], None
                if role == 0:
                    words.append(key)
                    ids.append(number)
                    counts.append(n)
                    continue
                if automaton is None:
                    automaton, words = Automaton(words), []
                for hit in automaton.one_error(key, len(key) - len(key) // 2 if backward else len(key) // 2):
                    for column, values in zip(out, ((number, ids[hit]), (ids[hit], number), (counts[hit], n))):
                        column += values
                if len(out[0]) >= _BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], _PAIR)
                    out = ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], _PAIR)

    return run


def _ordered(words: DataFrame, parts: int, block_words: int, block_chars: int, label: str) -> DataFrame:
    """Rows in order of ``key``, with ``place`` and ``block``; stored."""
    schema = f"{', '.join(f'{c} {kind}' for c, kind in words.dtypes)}, place long, block long"
    return durable(words.repartitionByRange(parts, "key").sortWithinPartitions("key").mapInArrow(_numbered(block_words, block_chars), schema), label)


def _pairs(ordered: DataFrame, backward: bool) -> DataFrame:
    """(id, near_id, near_n) of one direction, both ways; some twice."""
    known = ordered.groupBy("block").agg(F.min(F.substring("key", 1, _KNOWN)).alias("start")).orderBy("start", "block").collect()
    dealt = ordered.mapInArrow(_dealt([r.start for r in known], [r.block for r in known], backward), "block long, role int, key string, id long, n long")
    sorted_ = dealt.repartition(max(1, len(known)), "block").sortWithinPartitions("block", "role", "key")
    return sorted_.mapInArrow(_matched(backward), "id long, near_id long, near_n long")


def near_words(counts: DataFrame, block_words: int = BLOCK_WORDS, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, DataFrame]:
    """The words as (id, word, n), ids in code-point order, and for those with near
    words (id, n_near, best_id, best_n); both stored."""
    stored = durable(counts.select(F.col("word").alias("key"), "n"), "variant-words")
    total = stored.count()
    fill = max(block_words, math.ceil(total / MOST_BLOCKS))
    parts = max(math.ceil(total / fill), min(counts.sparkSession.sparkContext.defaultParallelism, total // 500 + 1))
    forward = _ordered(stored, parts, 2 * fill, block_chars, "variant-forward").withColumnRenamed("place", "id")
    backward = _ordered(forward.select(F.reverse("key").alias("key"), "id", "n"), parts, 2 * fill, block_chars, "variant-backward")
    pairs = _pairs(forward, False).unionByName(_pairs(backward, True))
    # dealt by id once: both groupings keep it
    once = pairs.repartition("id").groupBy("id", "near_id").agg(F.max("near_n").alias("near_n"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near_id"))
    near = once.groupBy("id").agg(F.count(F.lit(1)).alias("n_near"), best.alias("b"))
    near = durable(near.select("id", "n_near", F.col("b.near_id").alias("best_id"), (-F.col("b.less")).alias("best_n")), "variant-near")
    return forward.select("id", F.col("key").alias("word"), "n"), near


def roots(links: DataFrame, rounds: int) -> DataFrame:
    """(id, root_id) of stored (id, form_id): the end of each chain shorter than 2**``rounds``."""
    jumps = links.select("id", F.col("form_id").alias("root_id"))
    for i in range(rounds):
        further = jumps.select(F.col("id").alias("root_id"), F.col("root_id").alias("next_id"))
        jumps = durable(jumps.join(further, "root_id", "left").select("id", F.coalesce("next_id", "root_id").alias("root_id")), f"variant-roots-{i}")
    return jumps


def group_variants(counts: DataFrame, ratio: int = 5, block_words: int = BLOCK_WORDS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word of (word, n).

    ``form`` is the near word of largest n if that is ``ratio`` times the
    word's n or more; ``root`` is the last form of the chain, the word itself
    without one.  ``ratio`` is 2 or more, so that chains end.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more")
    words, near = near_words(counts, block_words, block_chars)
    met = words.join(near, "id").where(F.col("best_n") >= F.lit(ratio) * F.col("n"))
    links = durable(met.select("id", F.col("best_id").alias("form_id"), F.col("best_n").alias("form_n")), "variant-links")
    largest = links.agg(F.max("form_n")).first()[0] or 1
    # n grows by the ratio with each form, so a chain has at most this many
    longest = int(math.log(largest) / math.log(ratio)) + 1
    ends = roots(links, math.ceil(math.log2(longest + 1)))
    named = words.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    ended = words.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    formed = links.join(ends, "id").join(named, "form_id").join(ended, "root_id").select("id", "form", "form_n", "root")
    out = words.join(near.select("id", "n_near"), "id", "left").join(formed, "id", "left")
    return out.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root"))
