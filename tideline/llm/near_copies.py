"""SimHash near-dedup (operator 10) at a similarity: five-word shingles, Jaccard similarity 0.8 or more.

A single fingerprint of 64 bits at 3 bits finds hardly anything but the closest copies at that similarity: two texts that share
0.8 of their shingles differ in some 15 % of their bits. So each text gets TABLES independent fingerprints of BITS bits over its
set of shingles, and in each table the vantage-point trees of simhash.py link what is at most DISTANCE bits apart: a spanning
forest of such pairs for each table, so their number grows with the texts, never with the square of a group. Texts with the same
words in a row are one class; every pair is checked exactly on the two shingle sets of its classes before it links them. Tables
are taken in ROUNDS, and classes that are connected already aren't checked again, so a large group takes a few checks for each
member.

Chance that two texts come within DISTANCE bits in a table at least, for the constants below: 0.93 at similarity 0.8, 0.997 at
0.85, above 0.9999 from 0.9 on. In a table's forest such a pair may stand apart, connected through others that are less alike;
only where that happens in all its tables is it missed. Links of random texts stay rare up to some 10**10 classes, beyond which
BITS and TABLES have to be raised together.

Defined results: words are split at white space and ASCII letters lowered; a text of fewer words than a shingle has one
shingle, all of it; texts without words (null, empty, white space) are one class; rows repeated share a component; a null
doc_id is never the smallest unless its component has no other; columns beyond doc_id and text are carried along, whatever their
names; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import simhash
from .common import BYTE_CODES, blocks_of, body, cut, lean, marked, marks, mix, prefixes, records_per_batch, row_key, scratch, spans_hash, text_buffers
from .components import connected_components

SHINGLE = 5
SIMILARITY = (4, 5)  # as a fraction, so that the bound itself is exact
TABLES, BITS, DISTANCE = 48, 48, 3
ROUNDS = (2, 8, TABLES)
PAIRS_PER_BATCH = 200
BLOCK = 1 << 20

WORDS = TABLES * BITS // 64  # the tables' bits, side by side
_FACTORS = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_LANES = np.uint64(0x0101010101010101)
_TEXT_BITS = np.uint64(20)  # a block holds at most as many texts as these bits can number
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODES = BYTE_CODES[_LOWER]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def shingles(raw: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each text's words, hashes of all shingles, offsets of each text's shingles)."""
    inside = ~_SPACE[raw]
    edge = np.zeros(len(raw) + 1, bool)
    edge[offsets] = True
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    starts = np.flatnonzero(inside & (before | edge[:-1]))
    ends = np.flatnonzero(inside & (after | edge[1:])) + 1
    words = spans_hash(prefixes(_CODES[raw]), starts, ends)
    place = np.searchsorted(starts, offsets)
    n = np.diff(place)
    prefix = prefixes(words)
    whole = spans_hash(prefix, place[:-1], place[1:])
    many = np.where(n > 0, np.maximum(n - shingle + 1, 1), 0)
    bounds = np.concatenate([[0], np.cumsum(many)])
    at = np.arange(bounds[-1]) + np.repeat(place[:-1] - bounds[:-1], many)
    return whole, spans_hash(prefix, at, np.minimum(at + shingle, np.repeat(place[1:], many))), bounds


def fingerprints(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with shingles, their TABLES fingerprints): a bit is set if over half of the text's distinct shingles have it."""
    rows = np.flatnonzero(np.diff(bounds))
    if not len(rows):
        return rows, np.zeros((0, TABLES), np.uint64)
    text = np.repeat(np.arange(len(rows), dtype=np.uint64), np.diff(bounds)[rows])
    shift = np.uint64(64) - _TEXT_BITS
    own = np.unique((text << shift) | (hashes >> _TEXT_BITS))
    first = np.searchsorted(own >> shift, np.arange(len(rows), dtype=np.uint64))
    n = np.diff(np.append(first, len(own)))
    # bits are counted eight lanes at a time, in runs short enough for a lane of eight bits
    runs = -(-n // 255)
    begin = np.repeat(first, runs) + 255 * (np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs))
    of_text = np.cumsum(runs) - runs
    base = own & ((np.uint64(1) << shift) - np.uint64(1))
    bits = np.zeros((len(rows), WORDS, 64), np.uint8)
    for k, factor in enumerate(_FACTORS):
        word = mix(base * factor + factor)
        for b in range(8):
            lanes = np.add.reduceat((word >> np.uint64(b)) & _LANES, begin)
            counts = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int32), of_text, axis=0)
            bits[:, k, 8 * b : 8 * b + 8] = 2 * counts > n[:, None]
    bits = np.pad(bits.reshape(len(rows), TABLES, BITS), ((0, 0), (0, 0), (0, 64 - BITS)))
    return rows, np.packbits(bits, axis=2, bitorder="little").view(np.uint64)[:, :, 0]


@lean
def _describe(batches):
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        for i, j in blocks_of(offsets, BLOCK):
            for i, j in ((a, min(a + (1 << 16), j)) for a in range(i, j, 1 << 16)):
                whole, hashes, bounds = shingles(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                rows, found = fingerprints(hashes, bounds)
                sizes = np.zeros(j - i + 1, np.int32)
                sizes[rows + 1] = TABLES
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes, dtype=np.int32)), pa.array(found.reshape(-1).view(np.int64)))
                part = batch.slice(i, j - i)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("key"), pa.array(whole.view(np.int64)), lists], names=["doc_id", "key", "code", "prints"])


@lean
def _check(batches):
    up, down = SIMILARITY
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("text_a"), batch.column("text_b")):
            sets = []
            for text in (a.as_py(), b.as_py()):
                raw = np.frombuffer(text, np.uint8)
                sets.append(np.unique(shingles(raw, np.array([0, len(raw)]))[1]))
            n, m = map(len, sets)
            both = n + m - len(np.unique(np.concatenate(sets))) if min(n, m) * down >= max(n, m) * up else 0
            keep.append(both * down >= (n + m - both) * up)
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough, by their whole shingle sets."""
    left, right = (texts.select(F.col("code").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    with records_per_batch(pairs.sparkSession, PAIRS_PER_BATCH):  # two whole texts a row
        return cut(both.mapInArrow(_check, "a long, b long"))


def candidates(nodes: DataFrame) -> DataFrame:
    """nodes (code, prints) -> (a, b, tab): pairs of classes whose fingerprints are equal or near in a table, with their first table."""
    dealt = nodes.select("code", F.posexplode("prints").alias("tab", "print"))
    prints = cut(dealt.groupBy("tab", "print").agg(F.count(F.lit(1)).alias("n")))
    near = cut(simhash.near_links(prints.select("tab", F.col("print").alias("code")), DISTANCE, BITS))
    # only fingerprints that stand twice or in a link are looked up, all in one pass; read anew, so that a hot one's side of the joins can be split
    wanted = near.select("tab", F.explode(F.array("a", "b")).alias("print")).unionByName(prints.filter("n > 1").select("tab", "print"))
    met = cut(dealt.join(cut(wanted.distinct()), ["tab", "print"], "left_semi"))
    heads = cut(met.groupBy("tab", "print").agg(F.min("code").alias("head")))
    ends = [heads.select("tab", F.col("print").alias(c), F.col("head").alias(f"head_{c}")) for c in "ab"]
    linked = near.join(ends[0], ["tab", "a"]).join(ends[1], ["tab", "b"]).select("tab", F.col("head_a").alias("a"), F.col("head_b").alias("b"))
    alike = met.join(heads, ["tab", "print"]).select("tab", F.col("code").alias("a"), F.col("head").alias("b"))
    both = linked.unionByName(alike).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "tab")
    return both.groupBy("a", "b").agg(F.min("tab").alias("tab"))


def near_links(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """nodes (code, key, prints) -> exactly checked links (a, b)."""
    pairs = cut(candidates(nodes))
    met = pairs.select(F.col("a").alias("code")).unionByName(pairs.select(F.col("b").alias("code"))).distinct()
    keys = cut(nodes.select("code", "key").join(met, "code"))
    rows = docs.select(row_key().alias("key"), F.encode(body(), "UTF-8").alias("text"))
    some = rows.filter(marked(marks(keys, "key"), "key"))  # few texts are in a pair: only these are moved
    texts = cut(keys.join(some, "key").groupBy("code").agg(F.first("text").alias("text")))
    links, since = docs.sparkSession.createDataFrame([], "a long, b long"), 0
    for until in ROUNDS:
        some = pairs.filter(F.col("tab").between(since, until - 1)).select("a", "b")
        if since:
            roots = connected_components(links)
            for c in "ab":
                root = roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
                some = some.join(root, c, "left").withColumn(f"root_{c}", F.coalesce(f"root_{c}", c))
            some = some.filter("root_a <> root_b").select("a", "b")
        links, since = links.unionByName(similar(cut(some), texts)), until
    return links


def near_components(docs: DataFrame) -> DataFrame:
    """(doc_id, key, code, root, component_id) for every row of docs; root tells components apart, even where doc_ids repeat."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), body().alias("text"))
    described = cut(rows.mapInArrow(_describe, "doc_id long, key long, code long, prints array<long>"))
    nodes = cut(described.groupBy("code").agg(F.min("doc_id").alias("first_id"), F.min("key").alias("key"), F.first("prints").alias("prints")))
    roots = connected_components(near_links(nodes, docs))
    linked = cut(nodes.join(roots, nodes["code"] == roots["node"], "left").select("code", "first_id", F.coalesce("root", "code").alias("root")))
    least = linked.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_code = cut(linked.join(least, "root").select("code", "root", "component_id"))
    return described.join(of_code, "code").select("doc_id", "key", "code", "root", "component_id")


def keep_smallest(docs: DataFrame) -> DataFrame:
    """One document of each component: the one with the smallest doc_id (of rows with that id, one)."""
    with scratch(docs.sparkSession):
        heads = simhash.heads(cut(near_components(docs)))
    return simhash.keep_rows(docs, *heads)
