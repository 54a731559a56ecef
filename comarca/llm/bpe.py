"""Byte-level BPE encoding and decoding with a rank file.

Method: length-bucketed padded numpy matrices.  The distinct matches of the
split pattern in a batch go, by length, into padded id matrices.  In each
round every row merges its leftmost pair of minimum rank; pair ranks come from
an open-addressing hash table probed for whole columns at once; the merged
slot is squeezed out of every row, and finished rows leave the matrix.
Matches longer than ``LONGEST_ROW`` bytes (the padded rounds are quadratic)
take the same merges from a heap instead.

Texts are cut before single blanks, where the pattern always cuts, and the ids
of such segments are cached in each Python worker up to a bound.

Defined results: null and empty texts have no ids, and decode to no bytes.
Repeated rows are encoded each; other columns pass through, and those named as
outputs give way to them.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, types as T

LONGEST_ROW = 256
_BUCKETS = (4, 6, 8, 10, 12, 14, 16, 20, 24, 32, 64, 128, LONGEST_ROW)
_NONE = np.int32(2**31 - 1)
_SLICE = 1024
_CACHED_CHARS = 48
_worker: dict = {}
#: A blank inside or at the end of a longer run of white space: there the
#: pattern does not cut before each blank.
_RUN = re.compile(r"\s (?=\s|\Z)")


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of base64 token, blank, rank."""
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in data.splitlines() if line)}


class PairTable:
    """(left id, right id) -> merged id, by linear probing over whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        left, right, merged = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a = ranks.get(token[:cut])
                b = ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        keys = self._key(np.array(left, np.int64), np.array(right, np.int64))
        self.bits = max(4, int(len(keys) * 3).bit_length())
        self.keys = np.full(1 << self.bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << self.bits, _NONE)
        slots, values = self._slot(keys), np.array(merged, np.int32)
        while len(keys):
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] == np.uint64(2**64 - 1)]
            self.keys[slots[first]], self.values[slots[first]] = keys[first], values[first]
            left_over = np.ones(len(keys), bool)
            left_over[first] = False
            keys, values = keys[left_over], values[left_over]
            slots = (slots[left_over] + 1) & ((1 << self.bits) - 1)

    @staticmethod
    def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys ^ (keys >> np.uint64(29))
        return ((mixed * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Merged ids, ``_NONE`` where a pair does not merge or an id is padding (< 0)."""
        out = np.full(len(a), _NONE)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        keys = self._key(a[open_], b[open_])
        slots = self._slot(keys)
        while len(open_):
            held = self.keys[slots]
            hit = held == keys
            out[open_[hit]] = self.values[slots[hit]]
            going = ~hit & (held != np.uint64(2**64 - 1))
            open_, keys, slots = open_[going], keys[going], (slots[going] + 1) & ((1 << self.bits) - 1)
        return out


class Codec:
    """Encoder and decoder for one rank file and split pattern."""

    def __init__(self, rank_file: bytes, pattern: str, cache_entries: int = 300_000):
        self.ranks = parse_ranks(rank_file)
        self.pairs = PairTable(self.ranks)
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in self.ranks.items()}
        self.byte_ids = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.tokens = np.empty(max(self.bytes_of) + 1, object)
        self.tokens[list(self.bytes_of)] = list(self.bytes_of.values())
        self.limit, self.young, self.old = cache_entries, {}, {}

    def _rounds(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of at most ``width`` bytes, each as packed uint32."""
        lengths = np.array([len(p) for p in pieces])
        flat = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        ids = np.full((len(pieces), width), -1, np.int32)
        ids[np.arange(width) < lengths[:, None]] = flat
        pair = self.pairs.find(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(pieces), -1)
        out, rows = [b""] * len(pieces), np.arange(len(pieces))
        while len(rows):
            at = pair.argmin(1) if pair.shape[1] else np.zeros(len(rows), np.int64)
            best = pair[np.arange(len(rows)), at] if pair.shape[1] else np.full(len(rows), _NONE)
            done = best == _NONE
            if done.any():
                ended = ids[done].astype("<u4").tobytes()
                full, step = ((ids[done] >= 0).sum(1) * 4).tolist(), 4 * ids.shape[1]
                for k, row in enumerate(rows[done].tolist()):
                    out[row] = ended[k * step : k * step + full[k]]
                rows, ids, pair, at, best = rows[~done], ids[~done], pair[~done], at[~done], best[~done]
                if not len(rows):
                    break
            n, wide = ids.shape
            line = np.arange(n)
            ids[line, at] = best
            keep = np.arange(wide) != (at + 1)[:, None]
            ids = ids[keep].reshape(n, wide - 1)
            pair = pair[keep[:, 1:]].reshape(n, wide - 2)
            for side in (at - 1, at):
                ok = (side >= 0) & (side < wide - 2)
                r, c = line[ok], side[ok]
                pair[r, c] = self.pairs.find(ids[r, c], ids[r, c + 1])
        return out

    def _long(self, piece: bytes) -> bytes:
        """The same merges for one long match: a heap of (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        first = self.pairs.find(np.array(ids[:-1], np.int32), np.array(ids[1:], np.int32)).tolist()
        heap = [(rank, i, ids[i], ids[i + 1]) for i, rank in enumerate(first) if rank != _NONE]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = after[i]
            if j < n:
                rank = self.ranks.get(self.bytes_of[ids[i]] + self.bytes_of[ids[j]])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j], after[i] = rank, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([t for t, on in zip(ids, alive) if on], "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of distinct matches: whole tokens first, the rest by bucket."""
        out = {p: self.ranks[p].to_bytes(4, "little") for p in pieces if p in self.ranks}
        rest = sorted((p for p in pieces if p not in out), key=len)
        low = 0
        for width in _BUCKETS:
            high = low
            while high < len(rest) and len(rest[high]) <= width:
                high += 1
            for at in range(low, high, 1 << 15):
                part = rest[at : min(high, at + (1 << 15))]
                out.update(zip(part, self._rounds(part, width)))
            low = high
        out.update((p, self._long(p)) for p in rest[low:])
        return out

    def _cut(self, text: str) -> list[str]:
        """Segments that the pattern treats separately; they join to the text."""
        if not text:
            return []
        if _RUN.search(text):
            return self.pattern.findall(text)
        head, *tail = text.split(" ")
        return [*([head] if head else []), *map(" ".__add__, tail)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed little-endian uint32 ids of each text."""
        cut = [self._cut(t) for t in texts]
        new = set().union(*cut).difference(self.young)
        if len(self.young) + len(new) > self.limit:  # two generations: what was not met since goes
            self.old, self.young = self.young, {}
            new = set().union(*cut)
        young, old = self.young, self.old
        if old:
            young.update((s, old[s]) for s in new.intersection(old))
            new = new.difference(old)
        misses = list(new)
        split = [[p.encode() for p in self.pattern.findall(s)] for s in misses]
        ids = self.encode_pieces(list(set().union(*split)))
        young.update((s, ids[ps[0]] if len(ps) == 1 else b"".join(map(ids.__getitem__, ps))) for s, ps in zip(misses, split))
        out = [b"".join(map(young.__getitem__, c)) for c in cut]
        for s in misses:
            if len(s) > _CACHED_CHARS:
                del young[s]
        return out

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids."""
        return b"".join(self.tokens[np.frombuffer(packed, "<u4")].tolist())


def _codec(shared, digest: str, pattern: str) -> Codec:
    """The worker's codec for a rank file; it outlives a task with its cache."""
    if (digest, pattern) not in _worker:
        _worker.clear()
        _worker[digest, pattern] = Codec(shared.value, pattern)
    return _worker[digest, pattern]


#: What a pass can return for each text, and how each is made from (ids, decoded bytes).
OUTPUTS = {
    "n_tokens": (T.LongType(), pa.int64(), lambda ids, raw: len(ids) // 4),
    "ids": (T.BinaryType(), pa.binary(), lambda ids, raw: ids),
    "decoded": (T.BinaryType(), pa.binary(), lambda ids, raw: raw),
    "ids_sha256": (T.StringType(), pa.string(), lambda ids, raw: hashlib.sha256(ids).hexdigest()),
    "decoded_sha256": (T.StringType(), pa.string(), lambda ids, raw: hashlib.sha256(raw).hexdigest()),
}
_DECODED = {"decoded", "decoded_sha256"}


def _pass(df: DataFrame, source: str, outputs: tuple[str, ...], rank_path: str, pattern: str, ids_of) -> DataFrame:
    """``df`` with column ``source`` replaced by ``outputs``; one Arrow pass, no shuffle."""
    with open(rank_path, "rb") as file:
        data = file.read()
    shared, digest = df.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()
    kept = [c for c in df.columns if c != source and c not in outputs]
    schema = T.StructType([*df.select(*kept).schema.fields, *(T.StructField(o, OUTPUTS[o][0]) for o in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared, digest, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, _SLICE):
                part = batch.slice(at, _SLICE)
                ids = ids_of(codec, part.column(part.schema.get_field_index(source)).to_pylist())
                raw = [codec.decode(i) for i in ids] if _DECODED & set(outputs) else ids
                made = [pa.array(map(OUTPUTS[o][2], ids, raw), OUTPUTS[o][1]) for o in outputs]
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), *made], schema.names)

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, rank_path: str, pattern: str, text_col: str = "text", outputs: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """Replace ``text_col`` by ``outputs``: ``ids`` are packed little-endian
    uint32; ``decoded`` and its digest come from decoding those ids."""
    return _pass(docs, text_col, outputs, rank_path, pattern, lambda codec, texts: codec.encode([t or "" for t in texts]))


def decode(encoded: DataFrame, rank_path: str, pattern: str, ids_col: str = "ids", outputs: tuple[str, ...] = ("decoded",)) -> DataFrame:
    """Replace packed ids (null: none) by ``outputs``."""
    return _pass(encoded, ids_col, outputs, rank_path, pattern, lambda codec, ids: [i or b"" for i in ids])
