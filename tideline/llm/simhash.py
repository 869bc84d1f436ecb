"""SimHash near-duplicates through vantage-point trees.

Fingerprints are taken once per document and reduced to the distinct ones. Their bits are divided into halves, and a
vantage-point tree for each half divides the fingerprints by Hamming distance within it: two fingerprints at most DISTANCE = 3 bits
apart differ in at most one bit of one half, so where a boundary parts them, both are within one bit of it (triangle bound). Every
fingerprint goes to the side where it lies, and from the outer side also to the inner one if its ball of one bit overlaps the
boundary, so the two meet in one of that half's shards. In a shard the tree goes on, over the same half, down to leaves in which all
are compared. What the half can't divide (fingerprints alike in it) goes through a tree over whole fingerprints: of two branches one
enters those that a ball of 3 bits overlaps, and is compared to what lives in the leaves.

Copies of a fingerprint over all shards grow with the depth of the trees, by about a seventh with every halving, and a leaf is counted with
its copies, so that shards keep their size whatever the number of fingerprints. Callers to
whom that matters more may take more parts than differing bits (parts=4): one part is then equal, the balls have radius 0 and cross
no boundary, the trees only name blocks of fingerprints that are equal in a part, and there are 4 copies at any size. Operator 10 takes
halves; the stages that only need its components (packing, near copies) take four parts.

A shard of over LIMIT fingerprints is divided again by Spark, by trees over the parts of the bits that the first part left, as deep as
that shard's own size asks (name and level stand in the shard's path), so none outgrows a task. With radius 0, fingerprints equal in the
part are compared inside a shard, long runs after a further division of the bits that are left. A shard returns links between pairs that
were not connected yet, not all pairs; components of the links are then joined up over all shards.

The trees are built from a bounded sample (SAMPLE fingerprints) and only divide the work: every fingerprint is indexed, and
every pair within the distance is found whatever the sample is.

Defined results: a text without words (null, empty, white space) has fingerprint zero and links like any other; rows
repeated with one doc_id share a component; a null doc_id is never the smallest unless its component has no other; columns
beyond doc_id and text are neither read nor in the way, whatever their names; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks_of, body, cut, lean, marked, marks, read_documents, row_key, scratch, smallest_hashes, text_buffers
from .components import connected_components

SHINGLE = 3
SEED = 42
DISTANCE = 3
HALVES = 2  # parts of operator 10: balls of DISTANCE // HALVES bits
PARTS = 4  # parts with balls of radius 0
BITS = 64
LEAF = 256  # fingerprints in a leaf of a shard's own tree
SAMPLE = 4096
SHARD_ROWS = 16_384  # fingerprints that a leaf of a tree is meant for
LIMIT = 4 * SHARD_ROWS  # a larger shard is divided by another level
LEVELS = 4
RUN = 512  # fingerprints alike in their part that are compared without a further division
FLUSH = 1 << 20  # fingerprints that are routed together
BLOCK = 1 << 18  # bytes of text that are fingerprinted together
SPANS = 1 << 15  # shingles that are hashed together

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_PLAIN = np.where(_SPACE, 32, np.arange(256)).astype(np.uint8)  # letters lowered, white space as spaces
_PLAIN[65:91] += 32
_LANES = np.uint64(0x0101010101010101)
_P1, _P2, _P3, _P4, _P5 = (np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxh64(data: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of data[start : start + size] for each span: those under 32 bytes together, longer ones by the library.

    The data hold eight bytes at least beyond the last span, so that words of eight can be read anywhere.
    """
    eight, four = (np.ndarray((len(data) - 7,), kind, data, strides=(1,)) for kind in ("<u8", "<u4"))
    h = np.uint64(seed) + _P5 + size.astype(np.uint64)
    for k in range(3):
        i = np.flatnonzero(size >= 8 * (k + 1))
        h[i] = _turn(h[i] ^ _turn(eight[start[i] + 8 * k] * _P2, 31) * _P1, 27) * _P1 + _P4
    i = np.flatnonzero(size & 4)
    h[i] = _turn(h[i] ^ four[start[i] + (size[i] & ~7)].astype(np.uint64) * _P1, 23) * _P2 + _P3
    for k in range(3):
        i = np.flatnonzero((size & 3) > k)
        h[i] = _turn(h[i] ^ data[start[i] + (size[i] & ~3) + k].astype(np.uint64) * _P5, 11) * _P1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    h ^= h >> np.uint64(32)
    i = np.flatnonzero(size >= 32)
    h[i] = np.array([xxhash.xxh64_intdigest(data[a : a + n], seed) for a, n in zip(start[i].tolist(), size[i].tolist())], np.uint64)
    return h


def text_prints(raw: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """The fingerprint of each text raw[offsets[i] : offsets[i + 1]]: a bit is set if over half of the text's shingles have it."""
    inside = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    new, last = edge[:-1].copy(), edge[1:].copy()
    new[1:] |= ~inside[:-1]
    last[:-1] |= ~inside[1:]
    starts, ends = np.flatnonzero(inside & new), np.flatnonzero(inside & last) + 1
    # words side by side, with one space between those of a text
    plain = np.append(_PLAIN[raw[inside | ~new]], np.zeros(8, np.uint8))
    sizes = ends - starts
    wide = sizes + ~edge[ends]
    starts, place = np.cumsum(wide) - wide, np.searchsorted(starts, offsets)
    words = np.diff(place)
    rows = np.flatnonzero(words)
    out = np.zeros(len(words), np.uint64)
    if not len(rows):
        return out
    n = np.maximum(words[rows] - shingle + 1, 1)
    first = np.cumsum(n) - n
    at = np.arange(n.sum()) + np.repeat(place[rows] - first, n)
    to = np.minimum(at + shingle, np.repeat(place[rows + 1], n)) - 1
    start, size = starts[at], starts[to] + sizes[to] - starts[at]
    hashes = np.concatenate([xxh64(plain, start[i : i + SPANS], size[i : i + SPANS]) for i in range(0, len(at), SPANS)])
    # bits are counted eight lanes at a time, in runs short enough for a lane of eight bits
    runs = -(-n // 255)
    of_text = np.cumsum(runs) - runs
    begin = np.repeat(first, runs) + 255 * (np.arange(runs.sum()) - np.repeat(of_text, runs))
    bits = np.zeros((len(rows), 64), bool)
    for b in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(b)) & _LANES, begin)
        bits[:, b::8] = 2 * np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), of_text, axis=0) > n[:, None]
    out[rows] = np.packbits(bits, axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def _fingerprints(shingle: int):
    @lean
    def run(batches):
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            codes = [text_prints(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], shingle) for i, j in blocks_of(offsets, BLOCK)]
            codes = np.concatenate([np.zeros(0, np.uint64), *codes])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(codes.view(np.int64))], names=["doc_id", "key", "code"])

    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, key, code): the fingerprint as a signed 64-bit number."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), body().alias("text"))
    return rows.mapInArrow(_fingerprints(shingle), "doc_id long, key long, code long")


def _bits(a: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a).astype(np.int16)


def divide(free: int, parts: int = PARTS) -> list[int]:
    """The bits set in `free` as masks of `parts` runs of about equal width (no more than there are bits)."""
    bits = [b for b in range(64) if free >> b & 1]
    edges = np.linspace(0, len(bits), min(parts, len(bits)) + 1).astype(int)
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(edges, edges[1:])]


def build_tree(codes: np.ndarray, mask: np.uint64, most: float, radius: int = 0):
    """Nested (vantage, median, inner, outer) over a sample; None for a leaf of at most `most`, or that can't be divided.

    With a radius, `most` is what a leaf holds with the copies that come in over its boundaries, and the two sides are alike with these.
    """
    if len(codes) <= max(most, 1):
        return None
    # of a few candidates the one whose distances spread most
    picks = codes[np.linspace(0, len(codes) - 1, min(8, len(codes))).astype(int)]
    some = codes[:: max(1, len(codes) // SAMPLE)]
    vantage = picks[int(np.argmax(_bits((some ^ picks[:, None]) & mask).std(axis=1)))]
    far = _bits((codes ^ vantage) & mask)
    if radius:
        upto = np.cumsum(np.bincount(far))
        held = np.maximum(np.append(upto[radius:], np.full(min(radius, len(upto)), len(codes))), len(codes) - upto)
        median = int(np.argmin(held))
        if 4 * held[median] > 3 * len(codes):
            return None  # copies would outweigh the division
    else:
        median = int(np.median(far))
        if median == far.max():
            median -= 1
    inner, outer = codes[far - radius <= median], codes[far > median]
    if not len(inner) or not len(outer):
        return None
    return vantage, median, build_tree(inner, mask, most, radius), build_tree(outer, mask, most, radius)


def route(tree, codes: np.ndarray, mask: np.uint64, radius: int, back: int | None = None, at: np.ndarray | None = None, name: int = 1):
    """(leaf, rows of codes): the leaves that each code's ball overlaps.

    `back` is the radius towards the outer side. With 0 a code goes inwards only: of two codes within the radius that a boundary
    parts, the outer one lies within the radius of the boundary and is copied to the inner one's side, so both still meet in a leaf.
    """
    back = radius if back is None else back
    at = np.arange(len(codes)) if at is None else at
    if not len(at):
        return
    if tree is None:
        yield name, at
        return
    vantage, median, inner, outer = tree
    far = _bits((codes[at] ^ vantage) & mask)
    yield from route(inner, codes, mask, radius, back, at[far - radius <= median], 2 * name)
    yield from route(outer, codes, mask, radius, back, at[far + back > median], 2 * name + 1)


def free_bits(path: str, bits: int, parts: int) -> tuple[int, int]:
    """(bits that the levels of a shard's path have left, the last level's part). A path is "table/part:leaf/part:leaf"."""
    free, last = (1 << bits) - 1, 0
    for step in path.split("/")[1:]:
        last = divide(free, parts)[int(step.split(":")[0])]
        free &= ~last
    return free, last


def _blocks(batch) -> list[tuple[str, bytes]]:
    """(path, codes) of a batch that has them, or of one with a row for each (tab, code)."""
    if "path" in batch.schema.names:
        return list(zip(batch.column("path").to_pylist(), batch.column("codes").to_pylist()))
    tabs, codes = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "code"))
    order = np.argsort(tabs, kind="stable")
    names, first = np.unique(tabs[order], return_index=True)
    return [(str(x), part.tobytes()) for x, part in zip(names, np.split(codes[order], first[1:]))]


def _send(points: np.ndarray, most: float, bits: int, parts: int, radius: int):
    """Fingerprints, in rows or in blocks (path, codes) -> blocks, each on its way to the shards of the next level.

    Blocks of a shard to divide again come with its `size`, which its trees are made for: balls that cross boundaries make copies at every level.
    """
    meant = len(points) * SHARD_ROWS

    @lean
    def run(batches):
        trees: dict[tuple, list] = {}
        sizes: dict[str, int] = {}

        def routed(path, codes):
            free, _ = free_bits(path, bits, parts)
            masks = divide(free, parts)
            leaf_most = meant / (1 << sizes[path].bit_length()) if radius and path in sizes else most
            of = "/".join(x.split(":")[0] for x in path.split("/")[1:]), leaf_most  # shards of like parts and size share their trees
            if of not in trees:
                trees[of] = [build_tree(points, np.uint64(m), leaf_most, radius) for m in masks]
            for k, (tree, mask) in enumerate(zip(trees[of], masks)):
                for leaf, at in route(tree, codes, np.uint64(mask), radius, 0):
                    yield f"{path}/{k}:{leaf}", codes[at].tobytes()

        def flushed(held):
            rows = [r for path, blobs in held.items() for r in routed(path, np.unique(np.frombuffer(b"".join(blobs), np.uint64)))]
            return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())], names=["path", "codes"])

        held, size = {}, 0
        for batch in batches:
            if "size" in batch.schema.names:
                sizes.update(zip(batch.column("path").to_pylist(), batch.column("size").to_pylist()))
            for path, blob in _blocks(batch):
                held.setdefault(path, []).append(blob)
                size += len(blob)
            if size >= 8 * FLUSH:
                yield flushed(held)
                held, size = {}, 0
        yield flushed(held)

    return run


class Links:
    """Pairs (a, b) of places, kept only while they connect what was apart."""

    def __init__(self, n: int):
        self.parent = np.arange(n)
        self.a: list[np.ndarray] = []
        self.b: list[np.ndarray] = []

    def root(self, x: np.ndarray) -> np.ndarray:
        while True:
            up = self.parent[x]
            if (up == self.parent[up]).all():
                return up
            x = self.parent[up]

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root(a), self.root(b)
            apart = ra != rb
            a, b, low, high = a[apart], b[apart], np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
            _, one = np.unique(high, return_index=True)  # each root is hung up once; the other pairs are looked at again
            if len(one):
                self.a.append(a[one])
                self.b.append(b[one])
            self.parent[high[one]] = low[one]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        none = [np.zeros(0, np.int64)]
        return np.concatenate(none + self.a), np.concatenate(none + self.b)


def link_trees(codes: np.ndarray, distance: int, links: Links, chunk: int = 1024) -> None:
    """Links what is within the distance: each fingerprint enters the branches of a vantage-point tree that its ball overlaps.

    Every fingerprint lives in one leaf; a pair is found where the ball of one reaches the leaf of the other.
    """
    whole = np.uint64((1 << 64) - 1)
    tree = build_tree(codes, whole, LEAF)
    home = dict(route(tree, codes, whole, 0))
    for leaf, visitors in route(tree, codes, whole, distance):
        own = home.get(leaf, np.zeros(0, np.int64))
        for i in range(0, len(visitors), chunk):
            some = visitors[i : i + chunk]
            a, b = np.nonzero(np.bitwise_count(codes[some][:, None] ^ codes[own][None, :]) <= distance)
            a, b = some[a], own[b]
            links.add(a[a != b], b[a != b])


def link_part(codes: np.ndarray, part: int, radius: int, distance: int, links: Links, strip: int = 64) -> None:
    """Links what is within the distance and, in `part`, within the radius: the tree over the part goes on down to small leaves.

    Leaves that the part can't divide are left to a tree over whole fingerprints.
    """
    sample = codes[:: max(1, 4 * len(codes) // SAMPLE)]
    mask = np.uint64(part)
    tree = build_tree(sample, mask, LEAF * len(sample) / max(1, len(codes)), radius)
    for _, at in route(tree, codes, mask, radius, 0):
        if len(at) > 4 * LEAF:
            alike = Links(len(at))
            link_trees(codes[at], distance, alike)
            a, b = alike.pairs()
            links.add(at[a], at[b])
            continue
        for i in range(0, len(at), strip):
            a, b = np.nonzero(np.bitwise_count(codes[at[i : i + strip]][:, None] ^ codes[at[i:]][None, :]) <= distance)
            links.add(at[i + a[a < b]], at[i + b[a < b]])


def link_equal(codes: np.ndarray, at: np.ndarray, part: int, free: int, distance: int, parts: int, links: Links) -> None:
    """Links those codes[at] within the distance that are equal in `part`; of a long run, those equal in a part of `free` besides."""
    value = codes[at] & np.uint64(part)
    order = np.argsort(value, kind="stable")
    at, value = at[order], value[order]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    end = np.append(first[1:], len(at))
    deep = free.bit_count() >= parts > distance
    for i, j in zip(first, end):
        if deep and j - i > RUN:
            left = free & int(np.bitwise_or.reduce(codes[at[i:j]] ^ codes[at[i]]))  # bits alike in the whole run divide nothing
            for more in divide(left, parts):
                link_equal(codes, at[i:j], more, left & ~more, distance, parts, links)
    stop = np.repeat(np.where(deep & (end - first > RUN), first, end), end - first)
    i, step = np.arange(len(at)), 1
    while len(i := i[i + step < stop[i]]):
        near = i[np.bitwise_count(codes[at[i]] ^ codes[at[i + step]]) <= distance]
        links.add(at[near], at[near + step])
        step += 1


def shard_links(codes: np.ndarray, path: str, distance: int, bits: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs of a shard: their components are those of all its pairs that its part is there to find."""
    codes = np.unique(codes)
    links = Links(len(codes))
    free, part = free_bits(path, bits, parts)
    if distance // parts:
        link_part(codes, part, distance // parts, distance, links)
    else:
        link_equal(codes, np.arange(len(codes)), part, free, distance, parts, links)
    a, b = links.pairs()
    return codes[a], codes[b]


def _search(distance: int, bits: int, parts: int):
    def run(key, table):
        path = key[0].as_py()
        codes = np.frombuffer(b"".join(x.as_py() for x in table.column("codes")), np.uint64)
        a, b = shard_links(codes, path, distance, bits, parts)
        return pa.table({"tab": pa.array(np.full(len(a), int(path.split("/")[0]), np.int32)), "a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

    return run


def near_links(codes: DataFrame, distance: int = DISTANCE, bits: int = BITS, parts: int = PARTS) -> DataFrame:
    """Distinct (tab, code) -> links (tab, a, b) within `distance`, whose components are those of all such pairs of a tab."""
    tabs, n = codes.agg(F.count_distinct("tab"), F.count(F.lit(1))).first()
    sample = smallest_hashes(codes.select("code"), SAMPLE)  # bounded: the trees only divide the work
    points = np.array([r[0] for r in sample.collect()], np.int64).view(np.uint64)
    most = len(points) * SHARD_ROWS * max(1, tabs) / max(1, n)
    send = _send(points, most, bits, parts, distance // parts)
    sent = codes.select("tab", "code")
    found, schema = None, "tab int, a long, b long"
    for level in range(LEVELS):
        sent = cut(sent.mapInArrow(send, "path string, codes binary"))
        large = sent.groupBy("path").agg(F.expr("sum(octet_length(codes)) div 8").alias("size")).filter(F.col("size") > LIMIT)
        large = cut(large)
        last = level == LEVELS - 1 or large.isEmpty()
        here = sent if last else sent.join(large, "path", "left_anti")
        links = here.groupBy("path").applyInArrow(_search(distance, bits, parts), schema)
        found = links if found is None else found.unionByName(links)
        if last:
            return found
        sent = sent.join(large, "path")


def near_components(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, parts: int = PARTS) -> DataFrame:
    """(doc_id, key, code, root, component_id) for every row of docs; root tells components apart, even where doc_ids repeat."""
    prints = cut(fingerprints(docs, shingle))
    nodes = cut(prints.groupBy("code").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n")))
    links = near_links(nodes.select(F.lit(0).alias("tab"), "code"), distance, parts=parts)
    roots = connected_components(links.select("a", "b"))
    linked = nodes.join(roots, nodes["code"] == roots["node"], "left").select("code", "first_id", F.coalesce("root", "code").alias("root"))
    linked = cut(linked)
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_code = cut(linked.join(least, "root").select("code", "root", "component_id"))
    return prints.join(of_code, "code").select("doc_id", "key", "code", "root", "component_id")


def keep_smallest(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (of rows with that id, one)."""
    with scratch(docs.sparkSession):
        found = heads(cut(near_components(docs, shingle, distance)))
    return keep_rows(docs, *found)


def heads(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of each component of `found` (doc_id, key, root, component_id) the row with the smallest doc_id, and how often it repeats.

    Then the marks of every doc_id that stands in a row beyond those, or in one that repeats.
    """
    first = F.col("doc_id").eqNullSafe(F.col("component_id"))
    rows = found.filter(first).groupBy("root", "component_id", "key").agg(F.count(F.lit(1)).alias("n"))
    least = rows.groupBy("root", "component_id").agg(F.min(F.struct("key", "n")).alias("head"), F.sum("n").alias("of"))
    keep = cut(least.select(F.col("component_id").alias("__tl_id"), F.col("head.key").alias("__tl_key"), F.col("head.n").alias("__tl_n"), F.col("of").alias("__tl_of")), keep=True)
    others = found.filter(~first).select("doc_id").unionByName(keep.filter("__tl_of > 1").select(F.col("__tl_id").alias("doc_id")))
    return keep, marks(others, "doc_id", keep=True)


def keep_rows(docs: DataFrame, keep: DataFrame, others: DataFrame) -> DataFrame:
    """The rows of docs that `heads` names, each once, with their own columns.

    A doc_id without a mark stands in rows to keep only; the other rows alone are moved, to be joined to `keep`.
    """
    open_ = marked(others, F.col("doc_id").cast("long"))
    rows = docs.filter(open_).withColumn("__tl_row", row_key())
    keep = keep.filter(marked(others, "__tl_id"))

    def match(right):
        return rows["doc_id"].cast("long").eqNullSafe(right["__tl_id"]) & (rows["__tl_row"] == right["__tl_key"])

    sure = docs.filter(~open_)
    again = keep.filter("__tl_n > 1")
    if again.isEmpty():
        return sure.unionByName(rows.join(keep, match(keep), "left_semi").drop("__tl_row"))
    single = keep.filter("__tl_n = 1")
    once = rows.join(again, match(again), "left_semi").dropDuplicates(["doc_id", "__tl_row"])
    return sure.unionByName(rows.join(single, match(single), "left_semi").unionByName(once).drop("__tl_row"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_components(read_documents(spark, sf_dir), parts=HALVES)
    return found.select("doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")
