"""The registered query functions themselves, column by column against brute force.

The operators' tests hold their methods; these hold the thin queries: digests,
lengths, laws and flags that a query derives from its operator's output.
"""

import hashlib
import re
import struct
import zlib
from collections import Counter

import public_tokenizers
import pytest
import regex
import tiktoken
from tiktoken.load import load_tiktoken_bpe
import tokenizers
import xxhash

from comarca.llm import queries

SPACE = r"[\x20\x09-\x0D]+"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def rows_of(df, texts):
    rows = df.collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    return rows


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def test_op1(spark, sf_small, texts):
    library = tokenizers.Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    library.no_truncation()
    library.no_padding()
    for r in rows_of(queries.op1_token_counts(spark, sf_small), texts):
        text = texts[r.doc_id] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 2048)


def test_op4(spark, sf_small, texts):
    rows = rows_of(queries.op4_sharding(spark, sf_small), texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    shards = Counter(r.shard for r in rows)
    assert set(shards) <= set(range(16)) and max(shards.values()) - min(shards[s] for s in range(16)) <= 1
    for s in range(16):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(shards[s]))


def test_op5(spark, sf_small, texts):
    path = str(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(path), special_tokens={})
    for r in rows_of(queries.op5_byte_bpe(spark, sf_small), texts):
        text = texts[r.doc_id] or ""
        ids = [i for m in regex.findall(public_tokenizers.PATTERN, text) for i in library.encode_ordinary(m)]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha(library.decode_bytes(ids)))


def test_op6(spark, sf_small, texts):
    seen, size = Counter(), 200
    data = {d: (t or "").encode() for d, t in texts.items()}
    for b in data.values():
        seen.update(b[i : i + size] for i in range(len(b) - size + 1))
    for r in rows_of(queries.op6_suffix_dedup(spark, sf_small), texts):
        b = data[r.doc_id]
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if seen[b[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = len(re.findall(b"\1+", bytes(gone)))
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g)))


def test_op7(spark, sf_small, texts):
    for r in rows_of(queries.op7_quality_rules(spark, sf_small), texts):
        text = texts[r.doc_id] or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = Counter(windows)
        inside = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
        failed = len(words) < 20 or 100 * len(inside) > 30 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), failed)
        assert not (failed and r.kept)


def test_op8(spark, sf_small, docs, texts):
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {d: len(WORD.findall(t or "")) for d, t in texts.items()}
    per = Counter()
    for d, n in size.items():
        per[source[d]] += n
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight, whole = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, sum(per.values())
    target, open_ = {}, set(names)
    while open_:  # full sources stop at three times their size, the rest is shared again
        left = whole - sum(target.values())
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] > 3 * per[s] * total}
        target |= {s: 3 * per[s] if s in full else left * weight[s] / total for s in (full or open_)}
        open_ -= full or open_
    first = rows_of(queries.op8_mixing(spark, sf_small), texts)
    taken = Counter()
    for r in first:
        assert (r["size"], r.source_size) == (size[r.doc_id], per[source[r.doc_id]])
        assert r.target == pytest.approx(target[source[r.doc_id]])
        assert r.taken <= 3 * r["size"] and (r["size"] == 0 and r.taken == 0 or r.taken % r["size"] == 0)
        taken[source[r.doc_id]] += r.taken
    largest = max(size.values())
    assert all(abs(taken[s] - target[s]) <= max(largest, 0.05 * target[s]) for s in names)
    again = {r.doc_id: r.taken for r in queries.op8_mixing(spark, sf_small).collect()}
    assert again == {r.doc_id: r.taken for r in first}


def test_op9(spark, sf_small, texts):
    prints = {}
    for d, t in texts.items():
        words = WORD.findall((t or "").translate(LOWER))
        shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    for r in rows_of(queries.op9_simhash(spark, sf_small), texts):
        assert (r.fingerprint, r.component_id) == (f"{prints[r.doc_id]:016x}", find(r.doc_id))


def test_op10(spark, sf_small, texts):
    kinds = {
        "assign": (re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
        "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
        "hex": (re.compile(r"[0-9a-f]+"), 0, 24),
    }
    order = list(kinds)
    for r in rows_of(queries.op10_secret_scan(spark, sf_small), texts):
        spans = [(m.start(), order.index(k), m.end()) for k, (p, g, least) in kinds.items() for m in p.finditer(texts[r.doc_id] or "") if len(m[g]) >= least]
        listed = [f"{order[k]}:{s}:{e}" for s, k, e in sorted(spans)]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in spans) for i in range(3)]
        assert r.base_sha256 == sha(",".join(listed).encode())
        assert set(listed) <= set(r.spans.split(",")) | {""}
        places = [(int(x.split(":")[1]), x.split(":")[0]) for x in r.spans.split(",") if x]
        assert [s for s, _ in places] == sorted(s for s, _ in places)
