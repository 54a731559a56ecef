import itertools
import random

import numpy as np
import xxhash

from comarca.llm import simhash


def brute_fp(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_groups(pairs):
    up = list(range(len(pairs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(pairs)), 2):
        if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 3:
            up[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(pairs):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    return sorted((str(doc), f"{fp:016x}", least.get(root(i))) for i, (doc, fp) in enumerate(pairs))


def test_golay_code_has_distance_eight_and_covers():
    checks = simhash.check_bits()
    weights = {bin(d << 12 | int(c)).count("1") for d, c in enumerate(checks)}
    assert weights == {0, 8, 12, 16, 24}
    counts = (simhash.nearest_data_errors(checks) >= 0).sum(1)
    assert set(counts.tolist()) == {1, 6}


def test_keys_meet_for_every_three_bits():
    rng = random.Random(5)
    golay = simhash.GolayKeys()
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        keys = [set(golay.of(np.array([x], np.uint64).view(np.int64))[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


def test_crowded_runs_lose_no_connection():
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 400:
        x = rng.choice(sorted(fps))
        for bit in rng.sample(range(20), rng.randint(1, 5)):
            x ^= 1 << bit
        fps.add(x)
    array = np.array(sorted(fps), np.uint64).view(np.int64)
    made = simhash.crowded_links(array)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 3 for a, b in made)
    names = {int(f): i for i, f in enumerate(array)}
    sets = simhash._Sets(len(array))
    for a, b in made:
        sets.join(names[a], names[b])
    for i, j in itertools.combinations(range(len(array)), 2):
        if ((int(array[i]) ^ int(array[j])) & (2**64 - 1)).bit_count() <= 3:
            assert sets.root(i) == sets.root(j)


def test_groups(docs, odd_docs):
    for df in (docs, odd_docs):
        rows = df.select("doc_id", "text").collect()
        want = brute_groups([(r.doc_id, brute_fp(r.text)) for r in rows])
        got = simhash.near_duplicates(df).withColumn("fp", simhash.hex_of("fp")).collect()
        assert sorted((str(r.doc_id), r.fp, r.component_id) for r in got) == want


def test_chain_of_links(spark):
    chain = [((1 << i) - 1) for i in range(0, 60, 2)]
    edges = spark.createDataFrame([(a, b) for a, b in zip(chain, chain[1:])], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {n: 0 for n in chain[1:]}
    assert simhash.components(edges.where("false")).count() == 0


def test_empty(docs):
    assert simhash.near_duplicates(docs.where("false")).count() == 0
