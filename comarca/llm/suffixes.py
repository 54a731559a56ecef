"""Removal of long byte strings that repeat anywhere in a corpus.

Method: external induced suffix sorting.  A shard of text is sorted by two
induction passes over bucket queues that carry (suffix, common prefix) tuples
and move to disk beyond a memory bound; common prefixes of suffixes that are
induced come from range minima over those of the suffixes they come from.
Suffixes that share their first ``length`` bytes stand next to each other.

Shards hold only text that could repeat.  Every ``length``-byte string is
named by the least hash of its grams, equal strings by equal names, and
the consecutive starts of one name make a window of text.  Windows meet by
name; those with a twin of equal content are one string repeated and covered
whole, and one of them goes on with every other window of that name.  Twins
inside a map batch are recognised there, so a passage that is in a third of
all documents sends one row for each batch.  A name that occurs once needs no
sorting unless its window repeats its own gram.

Windows that go on are split in cells: strings that start about equally far
before their gram, named by the bytes that all strings of the cell have.  A
window at the edge of a passage so falls apart into a cell inside it (twins),
one outside (alone), and one across.  Where a name still has very many
windows its cells are split again, in quarters, until it has few or a cell is
one string; each step makes a few rows of a window, whatever the group's size.

Two places differ from the textbook form.  The string of substring names is
ranked by prefix doubling and not by further levels of induction: its alphabet
has outgrown byte buckets, and only ``length`` bytes of order are needed.
The text of a shard itself is held in memory, two bytes for each byte of it;
the tuples, an order of magnitude larger, are what spills.  The queues' scratch
files are private to a task, nameless, and gone when it ends.

Rows are named by 128 bits of their id and text between the steps.  A stretch
with a period below a gram's length (a line of dashes, a run of blanks) is one
row, and one period of its starts stands for it.

Defined results: a null text is empty and loses nothing; a repeated row is
another place where its text starts; spans are in bytes of the UTF-8 text and
may cut a character, so what is kept is binary.  Columns other than the id and
the text do not pass through, whatever their names.  A very long text is cut
into windows like any other, in the memory of the task that holds it; one of a
period beyond a gram's length has a row for each period or so.
"""

from __future__ import annotations

import hashlib
import itertools
import tempfile
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import durable

LONGEST_GRAM = 48
SHARD_BYTES = 4 << 20
HELD_WINDOWS = 1 << 20
CROWDED = 256
SPREAD = 256
QUEUE_BYTES = 4 << 20
_SLICE = 2048
_SENTINEL, _SEPARATOR, _SHIFT = 0, 1, 2  # UTF-8 has no byte above 0xF4
_MOST = 255


# -- windows of equal names ---------------------------------------------------

def gram_of(length: int) -> int:
    """Bytes of the grams that name strings of a length."""
    return max(8, min(LONGEST_GRAM, length // 4))


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each gram, from its first and last eight bytes."""
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(words).view("<u8").ravel()
    h = words[: len(data) - gram + 1] * np.uint64(0x9E3779B97F4A7C15)
    h ^= (words[gram - 8 : len(data) - 7] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(7)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def windows(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(name, first start, end of starts, repeats its gram) of each window of a text."""
    gram = gram_of(length)
    grams = length - gram + 1
    h = _gram_hashes(np.frombuffer(data, np.uint8), gram)
    n_starts = len(data) - length + 1
    blocks = np.pad(h, (0, -len(h) % grams), constant_values=2**64 - 1).reshape(-1, grams)
    before = np.minimum.accumulate(blocks, 1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    least = np.minimum(after[:n_starts], before[grams - 1 : grams - 1 + n_starts])
    first = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    end, name = np.r_[first[1:], n_starts], least[first]
    own = np.empty(len(first), bool)
    inside = np.arange(grams)
    for at in range(0, len(first), 4096):
        part = slice(at, at + 4096)
        left = first[part] + (h[first[part][:, None] + inside] == name[part][:, None]).argmax(1)
        right = end[part] - 1 + grams - 1 - (h[(end[part] + grams - 2)[:, None] - inside] == name[part][:, None]).argmax(1)
        own[part] = left != right
    return name.view(np.int64), first, end, own


#: What a window is: its row's key, first start, end of starts, whether they are
#: covered already; the place of its gram and its text once it was split.
_FIELDS = {"part": pa.int64(), "name": pa.int64(), "content": pa.int64(), "row": pa.int64(), "row2": pa.int64(), "first": pa.int64(), "ends": pa.int64(), "gram": pa.int64(), "covered": pa.bool_(), "text": pa.binary(), "copies": pa.int32(), "own": pa.bool_(), "many": pa.bool_()}
_SQL = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}
_SPAN = ["row", "row2", "first", "ends", "name", "gram", "covered", "text"]


def _schema(columns: list[str]) -> str:
    return ", ".join(f"{c} {_SQL[_FIELDS[c]]}" for c in columns)


def _dealt(found: dict[str, np.ndarray], texts: int) -> pa.RecordBatch:
    """Windows of a batch of ``texts`` texts: ``copies`` 1 and over go on; 0 are covered already.

    One of equal windows goes on for the batch.  Windows meet by name; a name
    with many different windows here has several for sure, and but for one they
    meet by content only, so that a very common name is spread.
    """
    name, content, n = found["name"], found["content"], len(found["name"])
    order = np.lexsort((content, name))
    new = np.r_[True, (np.diff(name[order]) != 0) | (np.diff(content[order]) != 0)]
    new_name = np.r_[True, np.diff(name[order]) != 0]
    sizes = np.diff(np.r_[np.flatnonzero(new), n])
    copies = np.zeros(n, np.int32)
    copies[order[new]] = sizes
    twin = np.zeros(n, bool)
    twin[order] = np.repeat(sizes > 1, sizes)
    many, lead = np.zeros(n, bool), np.zeros(n, bool)
    which = np.cumsum(new_name) - 1
    many[order] = (np.bincount(which, new) > max(2, texts // SPREAD))[which]
    lead[order[new_name]] = True
    stays = copies == 0  # the twins that stay here go anywhere
    part = np.where(many & ~lead, name ^ content, name)
    heads = np.flatnonzero(twin & ~stays)  # the one that goes on stands for the batch; its own place is covered too
    rows = np.r_[np.arange(n), heads]
    own = found["own"] & ~stays
    columns = found | {"part": np.where(stays, found["row"], part), "copies": copies, "own": own, "many": many, "covered": found["covered"] | stays}
    columns = {c: columns[c][rows] for c in _FIELDS if c != "text"}
    columns["copies"][n:], columns["own"][n:], columns["part"][n:], columns["covered"][n:] = 0, False, found["row"][heads], True
    text = pa.array(np.where(np.r_[stays, np.ones(len(heads), bool)], None, found["text"][rows]) if found["text"] is not None else [None] * len(rows), pa.binary())
    return pa.RecordBatch.from_arrays([text if c == "text" else pa.array(columns[c], kind) for c, kind in _FIELDS.items()], list(_FIELDS))


def _covered(known: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    """Rows (row, row2, first, ends) that are covered already and go on to the result only."""
    row, row2, first, ends = map(list, zip(*known))
    none = [0] * len(known)
    given = {"part": row, "row": row, "row2": row2, "first": first, "ends": ends, "covered": [True] * len(known), "text": [None] * len(known), "own": [False] * len(known), "many": [False] * len(known)}
    return pa.RecordBatch.from_arrays([pa.array(given.get(c, none), kind) for c, kind in _FIELDS.items()], list(_FIELDS))


def _windows(keyed: DataFrame, length: int) -> DataFrame:
    """Windows of (row, row2, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _SLICE) for b in batches for at in range(0, b.num_rows, _SLICE)):
            parts, contents = [], []
            texts = batch.column(2).cast(pa.binary()).to_pylist()
            for row, row2, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                if len(data) < length:
                    continue
                name, first, end, own = windows(data, length)
                parts.append((name, np.full(len(name), row, np.int64), np.full(len(name), row2, np.int64), first, end, own))
                view = memoryview(data)
                contents += [xxhash.xxh64_intdigest(view[a:b]) for a, b in zip(first.tolist(), (end + length - 1).tolist())]
            if parts:
                name, row, row2, first, ends, own = map(np.concatenate, zip(*parts))
                n = len(name)
                yield _dealt({"name": name, "content": np.array(contents, np.uint64).view(np.int64), "row": row, "row2": row2, "first": first, "ends": ends, "gram": np.full(n, -1), "covered": np.zeros(n, bool), "own": own, "text": None}, len(texts))

    return keyed.mapInArrow(run, _schema(list(_FIELDS)))


def cells(length: int, level: int) -> int:
    """Starts of a cell: half of a gram's, then a quarter of those of the level above; one in the end."""
    return -(-(length - gram_of(length) + 1) // (2 * 4 ** (level - 1)))


def periodic_runs(text: bytes, first: int, grams: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """(first start, end of starts, period) of the stretches of a window that repeat with a period below a gram's length.

    There a start has a twin one period on or back, so all are covered, and one
    period of them has every string of the stretch.  A gram that follows itself
    at one distance again and again shows where to look.
    """
    gram, out = gram_of(length), []
    steps = np.diff(grams)
    edges = np.flatnonzero(np.diff(steps)) + 1
    for i, j in zip(np.r_[0, edges], np.r_[edges, len(steps)]):
        if i == j or (period := int(steps[i])) >= gram:
            continue
        a, b = int(grams[i]), int(grams[j]) + gram
        starts, run = b - a - length + 1, text[a - first : b - first]
        if starts >= 2 * period and run[period:] == run[:-period]:
            out.append((a, a + starts, period))
    return out


def split_window(text: bytes, first: int, ends: int, grams: np.ndarray, length: int, level: int, begin: int | None = None) -> Iterator[tuple[int, int, int, int]]:
    """(name, first, end of starts, gram) of the parts of a window, from the start ``begin`` on.

    ``text`` begins at ``first``; ``grams`` are the places of the window's
    gram.  A string belongs to its leftmost one, and how far before it the
    string starts says its cell, so equal strings get equal names: the hash
    of the bytes that every string of the cell has.
    """
    width, most = cells(length, level), length - gram_of(length) + 1
    at = first if begin is None else begin
    while at < ends:
        gram = int(grams[np.searchsorted(grams, at)])
        cell = (gram - at) // width
        end = min(ends, gram - cell * width + 1)
        low, high = gram - cell * width, gram - min((cell + 1) * width, most) + 1 + length
        yield xxhash.xxh64_intdigest(text[low - first : high - first], 4 * level * 4**level + cell), at, end, gram
        at = end


def _split(pieces: DataFrame, length: int, level: int) -> DataFrame:
    """Windows of (``_SPAN``) with their text, split in cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, _SLICE) for b in batches for at in range(0, b.num_rows, _SLICE)):
            names, contents, texts, rest, known = [], [], [], [], []
            for row, row2, first, ends, name, gram, covered, text in zip(*(c.to_pylist() for c in batch.columns)):
                if gram < 0:
                    grams = first + np.flatnonzero(_gram_hashes(np.frombuffer(text, np.uint8), gram_of(length)).view(np.int64) == name)
                else:
                    grams = np.array([gram])
                # of a periodic stretch one period is split; the stretch is one row, covered already
                stretches, at = [], first
                for a, b, period in periodic_runs(text, first, grams, length):
                    stretches += [(at, a, covered), (a, a + period, True)]
                    known.append((row, row2, a, b))
                    at = b
                for begin, end, before in (*stretches, (at, ends, covered)):
                    for part, a, b, place in split_window(text, first, end, grams, length, level, begin):
                        cut = text[a - first : b - first + length - 1]
                        names.append(part)
                        contents.append(xxhash.xxh64_intdigest(cut))
                        texts.append(cut)
                        rest.append((row, row2, a, b, place, before))
            if known:
                yield _covered(known)
            if names:
                row, row2, first, ends, gram, covered = map(np.array, zip(*rest))
                held = np.empty(len(texts), object)
                held[:] = texts
                yield _dealt({"name": np.array(names, np.uint64).view(np.int64), "content": np.array(contents, np.uint64).view(np.int64), "row": row, "row2": row2, "first": first, "ends": ends, "gram": gram, "covered": covered, "own": np.zeros(len(names), bool), "text": held}, batch.num_rows)

    return pieces.select(*_SPAN).mapInArrow(run, _schema(list(_FIELDS)))


def _meet(found: DataFrame) -> DataFrame:
    """Rows of (``_SPAN``, sort): windows to sort or known to be covered.

    A name is judged whole, up to ``HELD_WINDOWS``; a longer run goes on in
    parts cut between contents, as a name that has several.
    """
    columns = [c for c in _FIELDS if c != "part"]

    def judge(table: pa.Table, going_on: set[int]) -> pa.RecordBatch:
        name, content, copies, own, many, before = (table.column(c).to_numpy() for c in ("name", "content", "copies", "own", "many", "covered"))
        here = np.flatnonzero(copies == 0)
        left = np.flatnonzero(copies > 0)
        name, content, copies, own, many, before = (c[left] for c in (name, content, copies, own, many, before))
        rows, sort, covered = here, np.zeros(len(here), bool), np.ones(len(here), bool)
        if len(left):
            new_name = np.r_[True, np.diff(name) != 0]
            new = new_name | np.r_[True, np.diff(content) != 0]
            group, of_name = np.cumsum(new) - 1, np.cumsum(new_name) - 1
            total = np.bincount(group, copies)[group]
            several = (np.bincount(of_name, new)[of_name] > 1) | (np.bincount(of_name, many)[of_name] > 0) | np.isin(name, list(going_on))
            sorts = new & (several | own)
            twin = total > 1
            keep = sorts | (twin & (copies == 1))
            rows, sort, covered = np.r_[rows, left[keep]], np.r_[sort, sorts[keep]], np.r_[covered, (twin | before)[keep]]
        out = table.select([c for c in _SPAN if c not in ("covered", "text")]).take(rows)
        text = pc.if_else(pa.array(sort), table.column("text").take(rows), pa.scalar(None, pa.binary()))
        return pa.table([*out.columns, pa.array(covered), text, pa.array(sort)], [*out.column_names, "covered", "text", "sort"]).combine_chunks().select([*_SPAN, "sort"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many = None, set()
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                more = pa.Table.from_batches([batch])
                held = more if held is None else pa.concat_tables([held, more])
            if held is None or not held.num_rows:
                continue
            name = held.column("name").to_numpy()
            # a name's run may go on in the next batch
            end = len(name) if batch is None else int(np.searchsorted(name, name[-1]))
            part = set()
            if not end and len(name) > HELD_WINDOWS:
                content = held.column("content").to_numpy()
                end = int(np.searchsorted(content, content[-1]))
                part = {int(name[-1])} if end else set()
            if end:
                yield from judge(held.slice(0, end), many | part).to_batches()
                many = part or many & {int(name[end])} if end < len(name) else set()
                held = held.slice(end)

    dealt = found.repartition("part").sortWithinPartitions("name", "content").select(*columns)
    return dealt.mapInArrow(run, _schema(_SPAN) + ", sort boolean")


# -- induced sorting ----------------------------------------------------------

class BucketQueue:
    """A first-in first-out queue of (suffix, common prefix) for each leading byte.

    What comes in for a bucket waits; a reader gets all of it as one chunk, and
    chunks that were read can be read again backward.  Beyond ``most`` bytes
    everything held goes to a nameless scratch file.
    """

    def __init__(self, most: int = QUEUE_BYTES):
        self.waiting: list[list] = [[] for _ in range(256)]
        self.read: list[list] = [[] for _ in range(256)]
        self.held, self.most = 0, most
        self.file, self.at = None, 0

    def push(self, byte: int, suffixes: np.ndarray, common: np.ndarray) -> None:
        self.waiting[byte].append((suffixes, common))
        self.held += suffixes.nbytes + common.nbytes
        if self.held > self.most:
            self._spill()

    def _spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        for chunks in itertools.chain(self.waiting, self.read):
            for i, chunk in enumerate(chunks):
                if isinstance(chunk[0], np.ndarray):
                    self.file.seek(self.at)
                    chunk[0].tofile(self.file)
                    chunk[1].tofile(self.file)
                    chunks[i] = (self.at, len(chunk[0]), chunk[0].dtype)
                    self.at = self.file.tell()
        self.held = 0

    def _load(self, chunk: tuple) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(chunk[0], np.ndarray):
            return chunk
        at, n, kind = chunk
        self.file.flush()
        self.file.seek(at)
        return np.fromfile(self.file, kind, n), np.fromfile(self.file, np.uint8, n)

    def unread(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What waits in a bucket, and then what came in meanwhile."""
        while self.waiting[byte]:
            chunks, self.waiting[byte] = self.waiting[byte], []
            loaded = [self._load(c) for c in chunks]
            chunk = loaded[0] if len(loaded) == 1 else tuple(map(np.concatenate, zip(*loaded)))
            self.held += sum(a.nbytes + b.nbytes for (a, b), c in zip(loaded, chunks) if a is not c[0])
            self.read[byte].append(chunk)
            yield chunk

    def backward(self, byte: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for chunk in reversed(self.read[byte]):
            yield self._load(chunk)


def range_minima(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """min(values[first..last]) for each pair, by a table of powers of two."""
    span = last - first + 1
    level = np.frexp(span.astype(np.float64))[1] - 1
    out = np.empty(len(first), values.dtype)
    table, width = values, 1
    for step in range(int(level.max(initial=0)) + 1):
        at = np.flatnonzero(level == step)
        if len(at):
            out[at] = np.minimum(table[first[at]], table[last[at] - width + 1])
        if len(table) > width:
            table = np.minimum(table[:-width], table[width:])
        width *= 2
    return out


class _Scan:
    """One induction pass: reads suffixes in order and queues their predecessors."""

    def __init__(self, text: np.ndarray, wanted: np.ndarray, queue: BucketQueue, common: bool):
        self.text, self.wanted, self.queue, self.common = text, wanted, queue, common
        self.least = np.zeros(256, np.uint8)  # of common prefixes since the last entry of a bucket
        self.open = np.zeros(256, bool)

    def read(self, suffixes: np.ndarray, common: np.ndarray) -> None:
        before = suffixes - 1
        take = np.flatnonzero((suffixes > 0) & self.wanted[before])
        lead = self.text[before[take]]
        order = np.argsort(lead, kind="stable")
        take, lead = take[order], lead[order]
        heads = np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]]) if len(lead) else np.empty(0, np.int64)
        got = np.zeros(len(take), np.uint8)
        if self.common and len(common):
            if len(take):
                start = np.r_[0, take[:-1] + 1]
                start[heads] = 0
                got = range_minima(common, start, take)
                got[heads] = np.minimum(got[heads], self.least[lead[heads]])
                got = np.minimum(got, _MOST - 1) + np.uint8(1)
                got[heads[~self.open[lead[heads]]]] = 0
            self.least = np.minimum(self.least, common.min())
            if len(take):
                tails = np.r_[heads[1:], len(take)] - 1
                rest = take[tails] + 1
                more = rest < len(common)
                self.least[lead[tails]] = _MOST
                self.least[lead[tails[more]]] = range_minima(common, rest[more], np.full(more.sum(), len(common) - 1))
                self.open[lead[heads]] = True
        for a, b in zip(heads.tolist(), [*heads[1:].tolist(), len(take)]):
            self.queue.push(int(lead[a]), before[take[a:b]], got[a:b])


def _run_length(text: np.ndarray, at: int) -> int:
    """How often the byte at ``at`` stands there in a row, ``_MOST`` at most."""
    part = text[at : at + _MOST]
    other = np.flatnonzero(part != part[0])
    return int(other[0]) if len(other) else len(part)


def _induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, seed_common: np.ndarray, common: bool, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes from the largest down, in chunks with the prefix in common with the one before.

    ``small`` marks suffixes smaller than their successor; ``seeds`` are the
    leftmost of those in each run, sorted.
    """
    large = BucketQueue(most)
    scan = _Scan(text, ~small, large, common)
    lead = text[seeds]
    bounds = np.searchsorted(lead, np.arange(257))
    last_large = np.full(256, -1, np.int64)
    present = np.flatnonzero(np.bincount(text, minlength=256))
    for byte in present.tolist():
        for suffixes, shared in large.unread(byte):
            scan.read(suffixes, shared)
            last_large[byte] = suffixes[-1]
        a, b = bounds[byte], bounds[byte + 1]
        if b > a:
            shared = seed_common[a:b].copy()
            shared[0] = min(_run_length(text, last_large[byte]), _run_length(text, seeds[a])) if last_large[byte] >= 0 else 0
            scan.read(seeds[a:b], shared)
    smaller = BucketQueue(most)
    scan = _Scan(text, small, smaller, common)
    for byte in present[::-1].tolist():
        least = -1
        for suffixes, shared in smaller.unread(byte):
            yield suffixes, shared
            scan.read(suffixes, shared)
            least = suffixes[-1]
        after = 0  # prefix that the chunk above has in common with the one below
        if least >= 0 and last_large[byte] >= 0:
            after = min(_run_length(text, least), _run_length(text, last_large[byte]))
        for suffixes, shared in large.backward(byte):
            down = np.r_[np.uint8(after), shared[:0:-1]]
            yield suffixes[::-1], down
            scan.read(suffixes[::-1], down)
            after = shared[0]


def _equal_neighbours(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether each substring equals the one before it."""
    same = np.r_[False, lengths[1:] == lengths[:-1]]
    at = np.flatnonzero(same)
    step = 0
    while len(at):
        at = at[lengths[at] > step]
        bad = text[starts[at] + step] != text[starts[at - 1] + step]
        same[at[bad]] = False
        at = at[~bad]
        step += 1
    return same


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Prefix that each suffix has in common with the one before it, ``most`` (255 at most) at most.

    Eight bytes at a time; past the end the text goes on with zeros, which no
    suffix but the last holds.
    """
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(np.pad(text, (0, most + 16)), 8)).view("<u8").ravel()
    out = np.zeros(len(order), np.int64)
    at, step = np.arange(1, len(order)), 0
    while len(at) and step < most:
        differ = words[order[at] + step] ^ words[order[at - 1] + step]
        ended = np.flatnonzero(differ)
        low = differ[ended] & (~differ[ended] + np.uint64(1))
        out[at[ended]] = step + (np.frexp(low.astype(np.float64))[1] - 1) // 8
        at = at[differ == 0]
        step += 8
    out[at] = most
    return np.minimum(out, most).astype(np.uint8)


def _doubled_order(names: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes of a string of names by their first ``most`` names."""
    rank, step, n = names.astype(np.int64), 1, len(names)
    while True:
        after = np.r_[rank[step:] + 1, np.zeros(min(step, n), np.int64)] if step < n else np.zeros(n, np.int64)
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        new = np.r_[False, np.diff(key[order]) != 0]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        step *= 2
        if rank[order[-1]] == n - 1 or step >= most:
            return order


def sorted_suffixes(text: np.ndarray, length: int, most: int = QUEUE_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Suffixes of ``text`` (it ends with its only zero), largest first, with common prefixes.

    Suffixes that share ``length`` bytes (254 at most) come in any order.
    """
    n = len(text)
    changes = np.flatnonzero(text[1:] != text[:-1])
    small = np.ones(n, bool)
    small[: n - 1] = np.repeat(text[changes] < text[changes + 1], np.diff(np.r_[-1, changes]))
    seeds = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    kind = np.int32 if n < 2**31 else np.int64
    by_byte = seeds[np.argsort(text[seeds], kind="stable")].astype(kind)
    is_seed = np.zeros(n, bool)
    is_seed[seeds] = True
    order = [s[is_seed[s]] for s, _ in _induce(text, small, by_byte, np.zeros(len(seeds), np.uint8), False, most)]
    order = np.r_[np.concatenate([np.array([n - 1], kind), *[o[::-1] for o in order[::-1]]])] if order else by_byte
    order = order[np.r_[True, order[1:] != n - 1]]
    place = np.empty(n, kind)
    place[seeds] = np.arange(len(seeds))
    ends = np.r_[seeds[1:], n - 1] + 1
    names = np.empty(len(seeds), np.int64)
    at = place[order]
    names[at] = np.cumsum(~_equal_neighbours(text, order, (ends - seeds)[at])) - 1
    if len(seeds) and names.max() < len(seeds) - 1:
        order = seeds[_doubled_order(names, length)].astype(kind)
    yield from _induce(text, small, order, common_prefixes(text, order, min(_MOST, length)), True, most)


def repeated_starts(pieces: list[bytes], length: int, most: int = QUEUE_BYTES) -> np.ndarray:
    """Flags over the joined pieces (a gap of one after each): a ``length``-byte string that starts twice or more."""
    text = np.frombuffer(b"\xff".join([*pieces, b""]), np.uint8) + np.uint8(_SHIFT)  # 0xFF wraps round to the separator
    text = np.r_[text, np.uint8(_SENTINEL)]
    flags = np.zeros(len(text), bool)
    above = -1
    for suffixes, shared in sorted_suffixes(text, length, most):
        match = np.flatnonzero(shared >= length)
        flags[suffixes[match]] = True
        inner = match[match > 0]
        flags[suffixes[inner - 1]] = True
        if len(match) and match[0] == 0 and above >= 0:
            flags[above] = True
        above = suffixes[-1]
    at = 0
    for piece in pieces:  # a common prefix that runs past the end of a piece is none
        flags[max(at, at + len(piece) - length + 1) : at + len(piece) + 1] = False
        at += len(piece) + 1
    return flags


# -- the operator -------------------------------------------------------------

def _row_keys(id_col: str, text_col: str) -> list[Column]:
    return [F.xxhash64(id_col, text_col).alias("row"), F.xxhash64(F.lit(1), id_col, text_col).alias("row2")]


def _cut(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """``wanted`` windows with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for row, row2, data, spans in zip(*(batch.column(i).cast(pa.binary()).to_pylist() if i == 2 else batch.column(i).to_pylist() for i in range(4))):
                made += [(row, row2, s["first"], s["ends"], s["name"], s["gram"], s["covered"], data[s["first"] : s["ends"] + length - 1]) for s in spans]
            yield pa.RecordBatch.from_arrays([pa.array(c, _FIELDS[k]) for k, c in zip(_SPAN, zip(*made))] if made else [pa.array([], _FIELDS[k]) for k in _SPAN], _SPAN)

    asked = wanted.groupBy("row", "row2").agg(F.collect_set(F.struct("first", "ends", "name", "gram", "covered")).alias("spans"))
    return docs.join(asked, ["row", "row2"]).select("row", "row2", "text", "spans").mapInArrow(run, _schema(_SPAN))


def _sorted_spans(cut: DataFrame, length: int, shards: int) -> DataFrame:
    """(row, row2, a, b): byte spans that the suffix order of a shard shows to repeat."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([(c, _FIELDS[c]) for c in ("row", "row2", "first", "covered", "text")]))
        if not table.num_rows:
            return
        pieces = table.column("text").to_pylist()
        flags = repeated_starts(pieces, length)
        steps = np.diff(np.r_[False, flags, False].astype(np.int8))
        a, b = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        offsets = np.cumsum([0, *(len(p) + 1 for p in pieces)])
        piece = np.searchsorted(offsets, a, "right") - 1
        open_ = ~table.column("covered").to_numpy()[piece]
        a, b, piece = a[open_], b[open_], piece[open_]
        shift = table.column("first").to_numpy()[piece] - offsets[piece]
        keys = [table.column(c).to_numpy()[piece] for c in ("row", "row2")]
        yield pa.RecordBatch.from_arrays([*map(pa.array, keys), pa.array(a + shift), pa.array(b - 1 + shift + length)], ["row", "row2", "a", "b"])

    return cut.repartition(shards, "name").select("row", "row2", "first", "covered", "text").mapInArrow(run, "row long, row2 long, a long, b long")


def repeated_spans(docs: DataFrame, length: int = 200, crowded: int = CROWDED) -> DataFrame:
    """(row, row2, spans): byte spans of (row, row2, text) covered by a string that also starts elsewhere.

    Windows are split in cells once, and those of names with over ``crowded``
    different windows again, until no name outgrows a shard.
    """
    met = durable(_meet(_windows(docs, length)), "windows")
    whole, sorts = [met.where("covered")], []
    pieces, level = durable(_cut(docs, met.where("sort"), length), "cut-windows"), 0
    while pieces is not None:
        level += 1
        met = durable(_meet(_split(pieces, length, level)), f"cells{level}")
        whole.append(met.where("covered"))
        wanted = met.where("sort")
        names = durable(wanted.groupBy("name").count().where(F.col("count") > crowded).select("name"), f"crowded{level}")
        if cells(length, level) == 1 or names.isEmpty():
            sorts.append(wanted)
            break
        sorts.append(wanted.join(names, "name", "left_anti"))
        pieces = durable(wanted.join(names, "name").select(*_SPAN), f"again{level}")
    cut = reduce(DataFrame.unionByName, [w.select("name", "row", "row2", "first", "covered", "text") for w in sorts])
    if len(sorts) > 1:
        cut = durable(cut, "to-sort")
    size = cut.agg(F.sum(F.length("text"))).first()[0] or 0
    found = [_sorted_spans(cut, length, max(1, -(-size // SHARD_BYTES)))]
    found += [w.select("row", "row2", F.col("first").alias("a"), (F.col("ends") + length - 1).alias("b")) for w in whole]
    return reduce(DataFrame.unionByName, found).groupBy("row", "row2").agg(F.collect_set(F.struct("a", "b")).alias("spans"))


#: What can be returned for each row, from its bytes and merged spans.
OUTPUTS = {
    "n_bytes": (T.LongType(), pa.int64(), lambda data, spans, kept: len(data)),
    "n_removed": (T.LongType(), pa.int64(), lambda data, spans, kept: len(data) - len(kept)),
    "n_spans": (T.LongType(), pa.int64(), lambda data, spans, kept: len(spans)),
    "spans": (T.ArrayType(T.ArrayType(T.LongType())), pa.list_(pa.list_(pa.int64())), lambda data, spans, kept: spans),
    "kept": (T.BinaryType(), pa.binary(), lambda data, spans, kept: kept),
    "kept_sha256": (T.StringType(), pa.string(), lambda data, spans, kept: hashlib.sha256(kept).hexdigest()),
}


def merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    """Sorted spans without overlaps; spans that touch become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def remove_repeats(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("n_bytes", "n_removed", "spans", "kept"), crowded: int = CROWDED) -> DataFrame:
    """Rows of (id, outputs): each text without the bytes that repeat."""
    if not 8 <= length < _MOST:
        raise ValueError(f"length must be from 8 to {_MOST - 1}")
    keyed = docs.select(*_row_keys(id_col, text_col), F.coalesce(text_col, F.lit("")).alias("text"), F.col(id_col).alias("id"))
    spans = repeated_spans(keyed.select("row", "row2", "text"), length, crowded)
    schema = T.StructType([T.StructField(id_col, keyed.schema["id"].dataType), *(T.StructField(o, OUTPUTS[o][0]) for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for data, found in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist()):
                cut = merged([(s["a"], s["b"]) for s in found or []])
                kept = b"".join(data[a:b] for a, b in zip([0, *(b for _, b in cut)], [*(a for a, _ in cut), len(data)]))
                rows.append((data, cut, kept))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([OUTPUTS[o][2](*r) for r in rows], OUTPUTS[o][1]) for o in outputs)], schema.names)

    return keyed.join(spans, ["row", "row2"], "left").select("id", "text", "spans").mapInArrow(run, schema)
