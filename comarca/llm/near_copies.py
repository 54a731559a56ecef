"""Groups of texts whose five-word shingles are alike.

Golay-code fuzzy hashing as in :mod:`comarca.llm.simhash`, over a longer
fingerprint: a text's sketch holds, for each of 128 hash functions, the least
value over its shingles, so two texts agree in a value as often as their
shingle sets are alike.  A key is a band, two whole values and the nearest
codewords of 24 values' single bits.  Texts that meet in a key are candidates;
their shingle sets are compared, and only a similarity (Jaccard) of ``least``
or more links them.

Texts of one shingle set are one node before any key is made.  The nodes of a
key are compared in rounds: about ``HUBS`` of them are hubs and meet all the
others, what is alike becomes one component, and only keys whose other nodes
are still of several components go on, where all nodes outside a key's largest
component meet the others (first eight times the hubs, where they are very
many).  A pair is left out where both are of
one component already, where their sizes and the shingles that anybody else in
an open key has cannot make the similarity, and where their prints (the low
bits of all sketch values) are far apart.  The first two cost no link; the last
costs a pair at similarity 0.8 with a chance of some 0.005, and hardly any at
0.85.  A crowded group of copies ends after a round or two, linear in its size.

Defined results: a null, empty or blank text has no shingles and is alike with
others of that kind only; a text shorter than a shingle is one shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import discard, durable, sieve
from .simhash import GolayKeys, components, shingles

HUBS = 4
#: Sketch values, bands, and what a band takes of the sketch.
VALUES, BANDS, WHOLE, BITS = 128, 16, 2, 24
#: The low bits that a print keeps of each sketch value, in longs.
LOW_BITS, PRINT = 4, [f"p{i}" for i in range(16)]
#: What the nodes of a key are told apart by: their prints, shingles, and those of them that others may have.
TOLD = [*PRINT, "size", "common"]
#: Prints further apart than this are not compared: texts of similarity 0.8
#: are 102 of 1,024 bits apart in the mean, with a standard deviation of 13.5.
BITS_APART = 137
#: Beyond so many nodes outside a key's largest component more hubs are tried first.
CROWDED = 4096
_SLICE = 512
_CHUNK = 1 << 11
_RNG = np.random.default_rng(9)
_TIMES = _RNG.integers(0, 1 << 31, VALUES, np.uint32) * np.uint32(2) + np.uint32(1)
_PLUS = _RNG.integers(0, 1 << 32, VALUES, np.uint32)
_PICKED = np.stack([_RNG.choice(np.setdiff1d(np.arange(VALUES), np.arange(b * WHOLE, (b + 1) * WHOLE)), BITS, replace=False) for b in range(BANDS)])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(data: bytes, n: int = 5) -> np.ndarray:
    """The set of 64-bit hashes of a text's n-word shingles, sorted."""
    parts = shingles(data, n)
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(p) for p in parts), np.uint64, len(parts)))


def sketch(hashes: np.ndarray) -> np.ndarray:
    """The least value of each hash function over a set that is not empty, then the greatest ones."""
    least, most = np.full(VALUES, 0xFFFFFFFF, np.uint32), np.zeros(VALUES, np.uint32)
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), _CHUNK):
        mixed = (short[at : at + _CHUNK] ^ _PLUS[:, None]) * _TIMES[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
        np.maximum(most, mixed.max(axis=1), out=most)
    return np.r_[least, most]


def keys(golay: GolayKeys, sketches: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every key of a stack of sketches."""
    wide = sketches.astype(np.uint64)
    bits = (wide * _MIX >> np.uint64(40) & np.uint64(1)).astype(np.int64)
    rows, made = [], []
    for band, picked in enumerate(_PICKED):
        near = golay.codewords(bits[:, picked] @ (1 << np.arange(BITS)))
        whole = np.full(len(wide), band, np.uint64)
        for value in range(band * WHOLE, (band + 1) * WHOLE):
            whole = (whole ^ wide[:, value]) * _MIX
            whole ^= whole >> np.uint64(29)
        row, column = np.nonzero(near >= 0)
        rows.append(row)
        made.append((whole.view(np.int64) & ~np.int64(4095))[row] | near[row, column])
    return np.concatenate(rows), np.concatenate(made)


def prints(sketches: np.ndarray) -> np.ndarray:
    """Low bits of every sketch value, packed: rows of longs."""
    low = np.unpackbits((sketches & np.uint32(0xFF)).astype(np.uint8)[..., None], axis=-1, bitorder="little")[..., :LOW_BITS]
    return np.packbits(low.reshape(len(sketches), -1), axis=1, bitorder="little").view("<i8")


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, _SLICE):
            part = batch.slice(at, _SLICE)
            yield part, part.column(part.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def marked(docs: DataFrame, text_col: str, n: int) -> DataFrame:
    """``docs`` with ``node``, the name of the shingle set, its print and its keys instead of the text."""
    kept = [c for c in docs.columns if c != text_col]
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("node", T.LongType()), *(T.StructField(p, T.LongType()) for p in TOLD), T.StructField("keys", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = GolayKeys()
        for part, texts in _texts(batches, text_col):
            sets = [shingle_hashes(t or b"", n) for t in texts]
            nodes = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            full = [i for i, s in enumerate(sets) if len(s)]
            counts = np.zeros(len(sets), np.int64)
            found, printed = np.empty(0, np.int64), np.zeros((len(sets), len(PRINT)), np.int64)
            if full:
                sketches = np.stack([sketch(sets[i]) for i in full])
                printed[full] = prints(sketches)
                rows, found = keys(golay, sketches)
                rows = np.array(full)[rows]
                found = found[np.argsort(rows, kind="stable")]
                counts += np.bincount(rows, minlength=len(sets))
            size = pa.array([len(x) for x in sets], pa.int64())
            lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)], pa.int32()), pa.array(found))
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(nodes), *map(pa.array, np.ascontiguousarray(printed.T)), size, size, lists], schema.names)

    return docs.mapInArrow(run, schema)


def _met(nodes: DataFrame) -> DataFrame:
    """(key, node, n, ``TOLD``) of every key that two nodes and more have; ``n`` counts a key's nodes."""
    keyed = nodes.select(F.explode("keys").alias("key"), "node")
    shared = durable(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "near-keys")
    narrow = durable(sieve(keyed, "key", shared).join(shared, "key"), "near-keyed")
    met = durable(narrow.join(nodes.select("node", *TOLD), "node"), "near-met")
    _gone(shared, narrow)
    return met


def _gone(*stored: DataFrame) -> None:
    """Delete stored frames whose last reader has run."""
    for df in stored:
        discard(df)


def _first_round(met: DataFrame) -> DataFrame:
    """Members as :func:`_round` gives them while every node is a component of its own: all keys are open."""
    drawn = F.pmod(F.xxhash64(F.lit(0), "key", "node"), F.col("n") - 1) < HUBS
    return met.select("key", "node", F.col("node").alias("comp"), drawn.alias("hub"), F.lit(None).cast("array<long>").alias("keys"), *TOLD)


def _round(members: DataFrame, hubs: int, turn: int) -> DataFrame | None:
    """Members (key, node, comp, ``TOLD``) of the keys whose nodes are not of one component yet.

    ``hub`` tells the nodes to compare with the others of a key.  While a key
    is crowded, that is about ``hubs`` for each key (all where it has no more);
    then every node outside the largest component of one of its keys, which
    ``keys`` lists.
    """
    sizes = members.groupBy("key", "comp").count()
    most = sizes.groupBy("key").agg(F.max_by("comp", F.struct("count", "comp")).alias("most"), (F.sum("count") - F.max("count")).alias("rest"))
    open_ = durable(most.where("rest > 0"), "near-open")
    if (largest := open_.agg(F.max("rest")).first()[0]) is None:
        _gone(open_)
        return None
    joined = sieve(members, "key", open_).join(open_, "key")
    outside = F.col("comp") != F.col("most")
    if largest > CROWDED:
        drawn = F.pmod(F.xxhash64(F.lit(turn), "key", "node"), F.col("rest")) < hubs
        opened = durable(joined.select("key", "node", "comp", (outside & drawn).alias("hub"), F.lit(None).cast("array<long>").alias("keys"), *TOLD), "near-members")
        _gone(open_)
        return opened
    joined = durable(joined.withColumn("outside", outside), "near-outside")
    of_node = joined.groupBy("node").agg(F.max("outside").alias("hub"), F.collect_set("key").alias("keys"))
    opened = durable(joined.join(of_node, "node").select("key", "node", "comp", "hub", "keys", *TOLD), "near-members")
    _gone(open_, joined)
    return opened


def candidates(opened: DataFrame, least: tuple[int, int]) -> DataFrame:
    """(a, b): distinct pairs of a key's hubs with its nodes of other components.

    Left out are pairs whose prints are far apart and those whose sizes and
    common shingles cannot make the similarity ``least``.
    """
    hubs = opened.where("hub").select("key", F.col("node").alias("h"), *(F.col(c).alias(f"h_{c}") for c in ("comp", "keys", *TOLD)))
    apart = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"h_{p}"))) for p in PRINT), F.lit(0))
    most = F.least("common", "h_common")
    could = most * least[1] >= (F.col("size") + F.col("h_size") - most) * least[0]
    met = hubs.join(opened, "key").where((F.col("comp") != F.col("h_comp")) & (~F.col("hub") | (F.col("h") < F.col("node"))) & could & (apart <= BITS_APART))
    # a pair of several keys meets in the first of them, where hubs are hubs in all
    met = met.where(F.col("keys").isNull() | (F.array_min(F.array_intersect("keys", "h_keys")) == F.col("key")))
    return met.select(F.least("h", "node").alias("a"), F.greatest("h", "node").alias("b")).distinct()


def _common(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Members with ``common``: their shingles that another node among them has."""
    nodes = members.select("node").distinct()
    listed = sets.join(nodes, "node", "left_semi").select("node", F.explode("hashes").alias("shingle"))
    own = listed.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    own = durable(own, "near-own")
    out = durable(members.drop("common").join(own, "node", "left").withColumn("common", F.col("size") - F.coalesce("own", F.lit(0))).drop("own"), "near-common")
    _gone(own, members)
    return out


def _sets(texts: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _texts(batches, "text"):
            sets = [shingle_hashes(t or b"", n).view(np.int64) for t in found]
            yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("node")), pa.array(sets, pa.list_(pa.int64()))], ["node", "hashes"])

    return texts.select("node", "text").mapInArrow(run, "node long, hashes array<long>")


def near_copies(docs: DataFrame, row_key: tuple[str, str], id_col: str = "doc_id", text_col: str = "text", n: int = 5, least: tuple[int, int] = (4, 5)) -> DataFrame:
    """(id, ``row_key`` columns, group) of every row.

    ``row_key`` names two columns that say a row's id and text; ``group`` is
    the smallest node of the row's group.  ``least`` is the similarity that
    links, as a fraction.
    """
    row_key = list(row_key)
    rows = durable(marked(docs.select(id_col, text_col, *row_key), text_col, n), "near-nodes")
    nodes = durable(rows.groupBy("node").agg(F.min(F.struct(*row_key, *TOLD, "keys")).alias("r")).select("node", "r.*"), "near-distinct")
    named_rows = durable(rows.select(id_col, *row_key, "node"), "near-rows")  # from here on without keys and prints
    _gone(rows)
    met = _met(nodes)
    # written first, so that what is narrow can sieve the texts before any of them moves
    wanted = durable(nodes.select("node", *row_key).join(met.select("node").distinct(), "node", "left_semi"), "near-wanted")
    _gone(nodes)
    texts = sieve(docs.select(*row_key, F.col(text_col).alias("text")), row_key[0], wanted).dropDuplicates(row_key).join(wanted.hint("merge"), row_key)
    sets = durable(_sets(texts, n), "near-sets")
    _gone(wanted)
    left, right = (sets.select(F.col("node").alias(c), F.col("hashes").alias(f"_{c}")) for c in "ab")
    both = F.size(F.array_intersect("_a", "_b"))
    alike = both * least[1] >= (F.size("_a") + F.size("_b") - both) * least[0]
    forest = durable(met.select(F.col("node").alias("a"), F.col("node").alias("b")).where("false"), "near-links")
    opened, turn = _first_round(met), 0
    while opened is not None:
        pairs = durable(candidates(opened, least), "near-pairs")
        links = pairs.hint("merge").join(sieve(left, "a", pairs), "a").join(sieve(right, "b", pairs).hint("merge"), "b").where(alike).select("a", "b")
        before, forest = forest, components(forest.unionByName(links)).select(F.col("node").alias("a"), F.col("root").alias("b"))
        _gone(pairs, before)
        rest, turn = opened.where("NOT hub").drop("comp", "hub", "keys"), turn + 1
        named = rest.join(forest, F.col("node") == F.col("a"), "left").withColumn("comp", F.coalesce("b", "node")).drop("a", "b")
        named = durable(named, "near-named")
        _gone(met if turn == 1 else opened)
        opened = _round(named, HUBS * 8**turn, turn)
        _gone(named)
        if opened is not None:
            opened = _common(opened, sets)
    _gone(sets)
    rooted = forest.withColumnsRenamed({"a": "_node", "b": "root"})
    return named_rows.join(rooted, F.col("node") == F.col("_node"), "left").select(id_col, *row_key, F.coalesce("root", "node").alias("group"))
