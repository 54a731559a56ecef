"""SimHash fingerprints and exact near-duplicate groups.

Method: Golay-code fuzzy hashing.  Two fingerprints that differ in at most
three of 64 bits agree on one of four 16-bit blocks at least; of the other 48
bits, one 24-bit half differs in at most one bit.  Each half is decoded to the
nearest codewords of the extended binary Golay code: one where it lies within
three bits of the code, six where it lies at four.  Halves one bit apart share
a codeword, so the key (block, its bits, half, codeword) is met by every pair
within three bits.  Fingerprints that meet are verified on all 64 bits.

Equal fingerprints are one node before any key is made.  In a key's run,
linked fingerprints are found without pairing a crowded run: hubs gather what
lies within three bits of them, and only clusters whose hubs are within nine
bits, and not joined yet, are compared, until a first link joins them.
Connected components come from alternating large-star and small-star rounds
over stored edges.

Defined results: a null, empty or blank text has fingerprint zero and links
like any other; rows that repeat are members of their group; null ids are
never the smallest id of a group that has others.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import discard, durable

BITS_APART = 3
_SLICE = 512
_CHUNK = 1 << 15
_CROWDED = 32


# -- fingerprints -------------------------------------------------------------

def shingles(data: bytes, n: int) -> list[bytes]:
    """n-word shingles of UTF-8 text, A-Z lower-cased; a shorter text is one shingle."""
    found = data.lower().split()
    if len(found) <= n:
        return [b" ".join(found)] if found else []
    joined = b" ".join(found)
    ends = list(itertools.accumulate(len(w) + 1 for w in found))
    return [joined[a:b - 1] for a, b in zip([0, *ends], ends[n - 1:])]


def fingerprint(data: bytes, n: int = 3, seed: int = 42) -> int:
    """Bit i is set if more than half the shingle hashes have it; signed 64 bits."""
    parts = shingles(data, n)
    hashes = np.fromiter((xxhash.xxh64_intdigest(p, seed) for p in parts), np.uint64, len(parts))
    votes = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = hashes[at : at + _CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_ = np.packbits(2 * votes > len(hashes), bitorder="little") if len(hashes) else np.zeros(8, np.uint8)
    return int(set_.view("<i8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "fp", n: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with a fingerprint (long) instead of the text."""
    kept = [c for c in docs.columns if c not in (text_col, out_col)]
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField(out_col, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                texts = part.column(part.schema.get_field_index(text_col)).cast(pa.binary()).to_pylist()
                made = pa.array([fingerprint(t or b"", n, seed) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), made], schema.names)

    return docs.mapInArrow(run, schema)


# -- Golay keys ---------------------------------------------------------------

#: Fixed value: generator polynomial of the [23, 12] Golay code.
GENERATOR = 0b101011100011


def check_bits() -> np.ndarray:
    """The 12 check bits (11 of the cyclic code, then parity) of each 12-bit word."""
    out = np.zeros(4096, np.int64)
    for data in range(4096):
        rest = data << 11
        for bit in range(22, 10, -1):
            if rest >> bit & 1:
                rest ^= GENERATOR << (bit - 11)
        out[data] = rest << 1 | (bin(data).count("1") + bin(rest).count("1")) & 1
    return out


def nearest_data_errors(checks: np.ndarray) -> np.ndarray:
    """For each syndrome, the data part of its least errors: six columns, -1 where fewer."""
    out, weight = np.full((4096, 6), -1, np.int64), np.full(4096, 9)
    for n in range(5):
        for bits in itertools.combinations(range(24), n):
            error = sum(1 << b for b in bits)
            data, syndrome = error >> 12, (error & 4095) ^ int(checks[error >> 12])
            if weight[syndrome] >= n:
                weight[syndrome] = n
                out[syndrome, (out[syndrome] >= 0).sum()] = data
    return out


class GolayKeys:
    """Keys of fingerprints."""

    def __init__(self) -> None:
        self.checks = check_bits()
        self.errors = nearest_data_errors(self.checks)

    def codewords(self, half: np.ndarray) -> np.ndarray:
        """Indices of the nearest codewords of 24-bit words, -1 where fewer than six."""
        data, errors = half >> 12, self.errors[(half & 4095) ^ self.checks[half >> 12]]
        return np.where(errors >= 0, data[:, None] ^ errors, -1)

    def of(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, key) of every key of signed 64-bit fingerprints."""
        bits = fps.astype(np.int64).view(np.uint64)
        blocks = [((bits >> np.uint64(16 * i)) & np.uint64(0xFFFF)).astype(np.int64) for i in range(4)]
        rows, keys = [], []
        for exact in range(4):
            a, b, c = (blocks[i] for i in range(4) if i != exact)
            for side, half in enumerate((a << 8 | b >> 8, (b & 255) << 16 | c)):
                near = self.codewords(half)
                key = ((exact * 2 + side) << 28 | blocks[exact] << 12)[:, None] | near
                row, column = np.nonzero(near >= 0)
                rows.append(row)
                keys.append(key[row, column])
        return np.concatenate(rows), np.concatenate(keys)


def _keyed(nodes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = GolayKeys()
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), _CHUNK):
                part = fps[at : at + _CHUNK]
                rows, keys = golay.of(part)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])

    return nodes.select("fp").mapInArrow(run, "key long, fp long")


# -- verified links -----------------------------------------------------------

def _apart(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


class _Sets:
    """Disjoint sets of array places."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        self.up[self.root(i)] = self.root(j)


def crowded_links(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect whatever chains of three-bit steps connect, far fewer than all pairs."""
    links, hubs, members, left = [], [], [], np.arange(len(fps))
    while len(left):
        hub = fps[left[0]]
        near = _apart(fps[left], hub) <= BITS_APART
        links += [(int(hub), int(f)) for f in fps[left[near][1:]]]
        hubs.append(hub)
        members.append(fps[left[near]])
        left = left[~near]
    sets, heads = _Sets(len(hubs)), np.array(hubs)
    for i in range(len(hubs)):
        for j in np.flatnonzero(_apart(heads[i + 1 :], heads[i]) <= 3 * BITS_APART) + i + 1:
            if sets.root(i) == sets.root(j):
                continue
            few, many = sorted((members[i], members[j]), key=len)
            for f in few:
                met = np.flatnonzero(_apart(many, f) <= BITS_APART)
                if len(met):
                    links.append((int(f), int(many[met[0]])))
                    sets.join(i, j)
                    break
    return links


def run_links(keys: np.ndarray, fps: np.ndarray) -> np.ndarray:
    """Links (two columns) within the runs of sorted keys."""
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    lengths = np.diff(np.r_[starts, len(keys)])
    links = [np.empty((0, 2), np.int64)]
    small = np.repeat(lengths <= _CROWDED, lengths)
    for step in range(1, min(_CROWDED, int(lengths.max(initial=1)))):
        left = np.flatnonzero((keys[:-step] == keys[step:]) & small[:-step])
        left = left[_apart(fps[left], fps[left + step]) <= BITS_APART]
        links.append(np.stack([fps[left], fps[left + step]], 1))
    for i in np.flatnonzero(lengths > _CROWDED):
        found = crowded_links(np.unique(fps[starts[i] : starts[i] + lengths[i]]))
        links.append(np.array(found, np.int64).reshape(-1, 2))
    made = np.concatenate(links)
    made.sort(axis=1)
    return np.unique(made[made[:, 0] != made[:, 1]], axis=0)


def links(nodes: DataFrame) -> DataFrame:
    """(a, b): verified links between distinct fingerprints, enough to connect every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = np.empty(0, np.int64)
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                keys, fps = np.r_[keys, batch.column(0).to_numpy()], np.r_[fps, batch.column(1).to_numpy()]
            end = len(keys) if batch is None else int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
            if end:
                made = run_links(keys[:end], fps[:end])
                keys, fps = keys[end:], fps[end:]
                yield pa.RecordBatch.from_arrays([pa.array(made[:, 0]), pa.array(made[:, 1])], ["a", "b"])

    return _keyed(nodes).repartition("key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long").distinct()


# -- components ---------------------------------------------------------------

def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star round: edges (a, b) with a > b to edges that point at smaller nodes."""
    if larger:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = sides.groupBy("u").agg(F.min("v").alias("_m")).select("u", F.least("u", "_m").alias("m"))
    met = sides.join(least, "u")
    if larger:
        out = met.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); the root is a component's smallest node."""
    stored = durable(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct(), "links")
    mark = None
    while True:
        made = durable(_star(_star(stored, True), False), "stars")
        seen = made.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        discard(stored)
        stored = made
        if seen == mark or seen[0] == 0:
            return stored.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 3, seed: int = 42, extra: Sequence[str] = ()) -> DataFrame:
    """(id, fp, component_id, group) and ``extra`` columns of every row.

    ``component_id`` is the smallest id of the row's group, ``group`` the
    smallest fingerprint in it (a group name that is never null).
    """
    marked = durable(fingerprints(docs.select(id_col, text_col, *extra), text_col, n=n, seed=seed), "fingerprints")
    nodes = durable(marked.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    rooted = components(links(nodes)).withColumnRenamed("node", "fp")
    linked = nodes.join(rooted, "fp", "left").withColumn("group", F.coalesce("root", "fp"))
    least = linked.groupBy("group").agg(F.min("least").alias("component_id"))
    grouped = linked.select("fp", "group").join(least, "group")
    return marked.join(grouped, "fp").select(id_col, "fp", "component_id", "group", *extra)


def hex_of(fp: Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
