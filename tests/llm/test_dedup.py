"""Deduplicators against brute force, on documents with every awkward case."""

import hashlib
import random
import re
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tideline.llm import exact_dedup, simhash, suffix_dedup, window_dedup

LOW = -(1 << 63)


def sha(x: str | bytes) -> str:
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def same(found, want):
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)


def test_exact_dedup(docs, rows, no_docs):
    norm = [re.sub(r"[ \t\n\x0b\x0c\r]+", " ", r[1] or "") for r in rows]
    groups = defaultdict(list)
    for r, t in zip(rows, norm):
        groups[t].append(r[0])
    want, taken = [], set()
    for r, t in zip(rows, norm):
        ids = [i for i in groups[t] if i is not None]
        keep = min(ids) if ids else None
        first = r[0] == keep and t not in taken
        taken |= {t} if first else set()
        want.append((r[0], keep, len(groups[t]), first, sha(t)))
    found = exact_dedup.exact_dedup(docs, f"t{uuid.uuid4().hex}").select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    same(found, want)
    assert exact_dedup.exact_dedup(no_docs, f"t{uuid.uuid4().hex}").count() == 0


def test_index_persists(spark, docs, rows):
    table = f"t{uuid.uuid4().hex}"
    half = docs.filter("doc_id < 15")
    exact_dedup.exact_dedup(half, table).count()
    before = spark.table(table).count()
    again = exact_dedup.exact_dedup(half, table)
    assert again.filter("kept").count() == before  # the same rows stay as stood in the index
    exact_dedup.exact_dedup(docs, table).count()
    assert spark.table(table).count() == spark.table(table).select("text_sha256").distinct().count() == len({re.sub(r"\s+", " ", r[1] or "") for r in rows})


def test_keep_first_keeps_columns(docs, no_docs):
    kept = exact_dedup.keep_first(docs, f"t{uuid.uuid4().hex}")
    assert kept.columns == docs.columns
    texts = [re.sub(r"[ \t\n\x0b\x0c\r]+", " ", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts))
    assert exact_dedup.keep_first(no_docs, f"t{uuid.uuid4().hex}").count() == 0


def brute_bytes(rows, length):
    raw = [(r[1] or "").encode() for r in rows]
    seen = Counter(b[p : p + length] for b in raw for p in range(len(b) - length + 1))
    out = []
    for r, b in zip(rows, raw):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        out.append((r[0], len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return out


def test_suffix_dedup(docs, rows, no_docs):
    for length in (400, 60):
        found = suffix_dedup.digests(docs, length).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        same(found, brute_bytes(rows, length))
    assert suffix_dedup.digests(no_docs).count() == 0


def test_suffix_dedup_of_runs_and_shared_beginnings(spark):
    """Long runs of one byte, passages that agree in their first 399 bytes only, and passages shifted against each other."""
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    base, run, tail = text(900), "x" * 1000, text(450)
    texts = [base, base[:399] + text(300), text(50) + base[501:], base[3:402], base[3:403], run, run[:401] + "y" + run[:399], "y" + run[:400], "ab" * 700]
    texts += [text(20) + tail + text(k) for k in (0, 1, 700)] + [tail[:225] + tail[226:], "é" * 250, "é" * 199 + "e"]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = suffix_dedup.digests(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    same(found, brute_bytes(rows, 400))


def test_suffix_dedup_text(docs, rows):
    out = suffix_dedup.without_repeats(docs)
    assert out.columns == docs.columns and out.count() == len(rows)
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)


def brute_words(rows, length):
    words = [re.findall(r"[^ \t\n\x0b\x0c\r]+", r[1] or "") for r in rows]
    first = {}
    for r, w in zip(rows, words):
        for p in range(len(w) - length + 1):
            k, at = tuple(w[p : p + length]), (LOW if r[0] is None else r[0], p)
            first[k] = min(first.get(k, at), at)
    out = []
    for r, w in zip(rows, words):
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if first[tuple(w[p : p + length])] < (LOW if r[0] is None else r[0], p):
                gone[p : p + length] = [True] * length
        out.append((r[0], len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


def test_window_dedup(docs, rows, no_docs):
    found = window_dedup.digests(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same(found, brute_words(rows, 20))
    assert window_dedup.digests(no_docs).count() == 0


def brute_print(text):
    words = re.findall(r"[^ \t\n\x0b\x0c\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(codes, distance):
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= distance:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(codes))]


def test_simhash(docs, rows, no_docs):
    codes = [brute_print(r[1]) for r in rows]
    groups = brute_groups(codes, 3)
    least = {g: min((r[0] for r, h in zip(rows, groups) if h == g and r[0] is not None), default=None) for g in groups}
    want = [(r[0], f"{c:016x}", least[g]) for r, c, g in zip(rows, codes, groups)]
    for parts in (simhash.HALVES, simhash.PARTS):
        found = [(r.doc_id, f"{r.code % (1 << 64):016x}", r.component_id) for r in simhash.near_components(docs, parts=parts).collect()]
        same(found, want)
    assert simhash.near_components(no_docs).count() == 0
    kept = simhash.keep_smallest(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert set(ids) == set(least.values()) and all(n == len([g for g in least if least[g] == i]) for i, n in ids.items())


def components(codes, links):
    parent = {c: c for c in codes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        i, j = find(a), find(b)
        parent[max(i, j)] = min(i, j)
    return {c: find(c) for c in codes}


def chains(rng, many, steps, width=64):
    """Fingerprints in chains: neighbours are near, the ends of a chain aren't."""
    codes = set()
    for c in rng.integers(0, 1 << (width - 1), many, dtype=np.uint64).tolist():
        for _ in range(steps):
            codes.add(c)
            for b in rng.integers(0, width, rng.integers(1, 4)).tolist():
                c ^= 1 << b
    return np.array(sorted(codes), np.uint64)


def all_links(codes, distance):
    return [(a, b) for a in codes for b in codes if b < a and (a ^ b).bit_count() <= distance]


def routed(codes, bits, parts, distance, most):
    """Every shard of the first level, as a task gets it, and the number of copies in them."""
    blob = pa.RecordBatch.from_arrays([pa.array(["0"]), pa.array([codes.tobytes()], pa.binary())], names=["path", "codes"])
    sent = list(simhash._send(codes[:: max(1, len(codes) // 300)], most, bits, parts, distance // parts)([blob]))
    shards = {}
    for batch in sent:
        for path, c in zip(batch.column("path").to_pylist(), batch.column("codes").to_pylist()):
            shards[path] = np.concatenate([shards.get(path, codes[:0]), np.frombuffer(c, np.uint64)])
    return shards


@pytest.mark.parametrize("bits,parts,distance", [(64, 4, 3), (48, 4, 3), (64, 2, 3), (64, 3, 4)])
def test_shards_lose_no_link(monkeypatch, bits, parts, distance):
    """With and without balls that cross boundaries; long runs are divided again."""
    monkeypatch.setattr(simhash, "RUN", 4)
    codes = chains(np.random.default_rng(11), 60, 10, bits)
    links = []
    for path, held in routed(codes, bits, parts, distance, 20).items():
        a, b = simhash.shard_links(held, path, distance, bits, parts)
        assert len(a) < 4 * len(held)  # not all pairs
        links += zip(a.tolist(), b.tolist())
    assert all(0 < (a ^ b).bit_count() <= distance for a, b in links)
    assert components(codes.tolist(), links) == components(codes.tolist(), all_links(codes.tolist(), distance))


def test_a_dense_shard_loses_no_link(monkeypatch):
    """All fingerprints of one shard are alike in its part, so only the bits that are left divide them."""
    monkeypatch.setattr(simhash, "RUN", 16)
    codes = np.unique(chains(np.random.default_rng(5), 40, 25, 48))  # the upper 16 bits are zero
    path = "0/3:1"
    free, part = simhash.free_bits(path, 64, 4)
    assert part == 0xFFFF << 48 and free == (1 << 48) - 1
    a, b = simhash.shard_links(codes, path, 3, 64, 4)
    assert components(codes.tolist(), zip(a.tolist(), b.tolist())) == components(codes.tolist(), all_links(codes.tolist(), 3))


@pytest.mark.parametrize("parts,least,most", [(simhash.PARTS, [4, 4], [4, 4]), (simhash.HALVES, [3, 7], [6, 12])])
def test_copies_over_shards(parts, least, most):
    """Copies of a fingerprint over all shards of production size, at 10^5 and 10^6: constant without boundaries, else growing with depth."""
    rng = np.random.default_rng(2)
    copies = []
    for n in (100_000, 1_000_000):
        codes = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        sample = codes[:: len(codes) // simhash.SAMPLE]
        total = 0
        for mask in simhash.divide((1 << 64) - 1, parts):
            tree = simhash.build_tree(sample, np.uint64(mask), len(sample) * simhash.SHARD_ROWS / n)
            total += sum(len(at) for _, at in simhash.route(tree, codes, np.uint64(mask), simhash.DISTANCE // parts))
        copies.append(total / len(codes))
    assert all(a <= c <= b for a, c, b in zip(least, copies, most))


def test_shards_keep_their_size():
    """At 3 * 10^6 fingerprints no shard is over the limit, which would divide it anew with further copies; a fingerprint has few copies."""
    codes = np.unique(np.random.default_rng(8).integers(0, 1 << 63, 3_000_000, dtype=np.uint64))
    sample = codes[:: len(codes) // simhash.SAMPLE]
    send = simhash._send(sample, len(sample) * simhash.SHARD_ROWS / len(codes), 64, simhash.HALVES, simhash.DISTANCE // simhash.HALVES)
    sizes = Counter()
    for batch in send([pa.RecordBatch.from_arrays([pa.array(["0"]), pa.array([codes.tobytes()], pa.binary())], names=["path", "codes"])]):
        sizes.update(dict(zip(batch.column("path").to_pylist(), (len(c) // 8 for c in batch.column("codes").to_pylist()))))
    assert max(sizes.values()) <= simhash.LIMIT and sum(sizes.values()) < 9 * len(codes)


def test_a_large_shard_is_divided_by_its_own_size():
    """A shard that goes to the next level makes as many leaves as it needs, not as many as the whole table did."""
    rng = np.random.default_rng(12)
    codes = np.unique(rng.integers(0, 1 << 63, 100_000, dtype=np.uint64))
    batch = pa.RecordBatch.from_arrays([pa.array(["0/0:1"]), pa.array([codes.tobytes()], pa.binary()), pa.array([len(codes)])], names=["path", "codes", "size"])
    (sent,) = simhash._send(codes[::25], 4, 64, simhash.HALVES, 1)([batch])  # 4 of the sample: meant for a table of 16 million
    assert sum(len(c) // 8 for c in sent.column("codes").to_pylist()) < 8 * len(codes)


def test_pairs_meet_inwards():
    """Copies only go from the outer to the inner side, yet pairs within the radius share a leaf; the tree is counted with its copies."""
    codes = chains(np.random.default_rng(6), 300, 10)
    mask = np.uint64((1 << 32) - 1)
    tree = simhash.build_tree(codes, mask, 40, 1)
    leaves = [set(at.tolist()) for _, at in simhash.route(tree, codes, mask, 1, 0)]
    assert max(map(len, leaves)) <= 40 and sum(map(len, leaves)) < sum(len(at) for _, at in simhash.route(tree, codes, mask, 1))
    for i in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count((codes[:i] ^ codes[i]) & mask) <= 1):
            assert any(i in leaf and j in leaf for leaf in leaves)


def test_a_shard_alike_in_its_half_loses_no_link():
    """More than a leaf's worth of fingerprints that their half can't divide: whole fingerprints do."""
    codes = np.unique(chains(np.random.default_rng(15), 150, 25, 32))  # the upper half is zero
    free, part = simhash.free_bits("0/1:1", 64, 2)
    assert part == 0xFFFFFFFF << 32 and len(codes) > 4 * simhash.LEAF
    a, b = simhash.shard_links(codes, "0/1:1", 3, 64, 2)
    assert components(codes.tolist(), zip(a.tolist(), b.tolist())) == components(codes.tolist(), all_links(codes.tolist(), 3))


def test_fingerprints_in_batches():
    """Words and spans of all lengths, texts without words between them, over the borders of the runs in which bits are counted."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcXYZé0-\x85\u3000") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 9, 12, 31, 32, 40, 200])))
    space = lambda: "".join(rng.choice(" \t\n\x0b\x0c\r") for _ in range(rng.choice([1, 1, 1, 4])))
    texts = ["", " ", "a", *(rng.choice(["", space()]) + "".join(word() + space() for _ in range(rng.choice([0, 1, 2, 3, 4, 30, 255, 256, 257, 600]))) + rng.choice(["", word()]) for _ in range(200)), ""]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    want = [brute_print(t) for t in texts]
    assert simhash.text_prints(np.frombuffer(b"".join(raw), np.uint8), offsets).tolist() == want
    assert simhash.text_prints(np.zeros(0, np.uint8), np.zeros(3, np.int64)).tolist() == [0, 0]
    for text, code in zip(raw[:40], want):
        assert simhash.text_prints(np.frombuffer(text, np.uint8), np.array([0, len(text)])).tolist() == [code]


def test_trees_prune():
    """A shard of far fingerprints: every near pair is linked, at a part of all comparisons."""
    rng = np.random.default_rng(9)
    codes = np.unique(np.concatenate([rng.integers(0, 1 << 63, 8000, dtype=np.uint64), chains(rng, 30, 20)]))
    whole = np.uint64((1 << 64) - 1)
    tree = simhash.build_tree(codes, whole, simhash.LEAF)
    home = {leaf: len(at) for leaf, at in simhash.route(tree, codes, whole, 0)}
    compared = sum(len(at) * home.get(leaf, 0) for leaf, at in simhash.route(tree, codes, whole, 3))
    assert sum(home.values()) == len(codes) and compared < 0.7 * len(codes) ** 2
    links = simhash.Links(len(codes))
    simhash.link_trees(codes, 3, links)
    a, b = links.pairs()
    near = [(int(codes[i]), int(codes[j])) for i in range(len(codes)) for j in np.flatnonzero(np.bitwise_count(codes[:i] ^ codes[i]) <= 3)]
    assert components(codes.tolist(), zip(codes[a].tolist(), codes[b].tolist())) == components(codes.tolist(), near)


def test_smallest_hashes(spark):
    from pyspark.sql import functions as F

    from tideline.llm.common import smallest_hashes

    rows = spark.range(1000).unionByName(spark.range(500)).repartition(3)
    want = [r.id for r in spark.range(1000).orderBy(F.xxhash64("id", F.lit("x"))).limit(20).collect()]
    assert [r.id for r in smallest_hashes(rows, 20, "x").collect()] == want
    assert smallest_hashes(rows.limit(0), 20).count() == 0 and smallest_hashes(rows, 600).count() == 600


@pytest.mark.parametrize("parts", [simhash.PARTS, simhash.HALVES])
def test_levels_lose_no_link(spark, monkeypatch, parts):
    """Shards far over the limit go through several levels of trees; two tables stay apart."""
    monkeypatch.setattr(simhash, "SHARD_ROWS", 16)
    monkeypatch.setattr(simhash, "LIMIT", 40)
    codes = [chains(np.random.default_rng(k), 50, 20) for k in (3, 4)]
    codes.append(codes[0][::2])
    rows = [(k, x - (1 << 64) if x >> 63 else x) for k, some in enumerate(codes) for x in some.tolist()]
    links = simhash.near_links(spark.createDataFrame(rows, "tab int, code long").repartition(3), parts=parts).collect()
    assert len(links) < (12 if parts == simhash.PARTS else 60) * len(rows)  # each of these tiny shards has a forest of its copies
    for k, some in enumerate(codes):
        mine = [(r.a % (1 << 64), r.b % (1 << 64)) for r in links if r.tab == k]
        assert components(some.tolist(), mine) == components(some.tolist(), all_links(some.tolist(), 3))


def test_rows_of_one_id_stay_apart(spark):
    """Null ids and a repeated id, with texts whose 32-bit hashes clash: 450 shared bytes go, the 32 own bytes of each stay."""
    from pyspark.sql import functions as F

    from .conftest import SCHEMA

    rng = random.Random(4)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(450))
    texts = spark.range(200_000).select(F.concat(F.lit(shared), F.md5(F.col("id").cast("string"))).alias("text"))
    clashes = texts.groupBy(F.hash("text")).agg(F.sort_array(F.collect_list("text")).alias("t")).filter("size(t) > 1").orderBy("t").limit(2).collect()
    (a, b), (c, d) = (r.t[:2] for r in clashes)
    for ids in ((None, None), (3, 3), (3, 4)):
        rows = [(ids[0], a), (ids[1], b)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        found = suffix_dedup.digests(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
        same(found, brute_bytes(rows, 400))
        assert [r.n_removed for r in found] == [450, 450]
    rows = [(None, f"{c} {' '.join(map(str, range(40)))}"), (None, d), (7, f"x {' '.join(map(str, range(40)))}")]
    found = window_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    same(found, brute_words(rows, 20))
    wide = spark.createDataFrame([(None, a, *[None] * 10), (None, b, *[None] * 10)], SCHEMA)
    kept = suffix_dedup.without_repeats(wide, suffix_dedup.BYTES, 400)
    assert sorted(r.text for r in kept.collect()) == sorted((a[450:], b[450:]))
