"""Best-fit packing of documents into bins of equal capacity, under conflicts.

A duplicate cluster is a component of near copies as operator 10 finds them (three-word SimHash at 3 bits, exact copies among
them), unless the caller brings a table of clusters. A bin may not hold two documents of one cluster, nor more than PER_SOURCE documents of one source; it carries
a bitmap of its clusters and PER_SOURCE bitmaps of its sources (a source's bit stands in as many of them as the bin holds documents of
it). Bins stand in order of what is left in them; a document goes to the tightest bin that has room and no conflict, found by
going on from the tightest with room through its successors, and opens a bin only if none is compatible. Documents come
longest first. Those longer than a bin fill whole bins of their own, and the rest is packed like any other document.

Documents are dealt by a hash to groups of about GROUP rows, each packed by itself from (id, source, cluster, length), never
texts: a bounded number of small rows a task, whatever source or cluster is hot. Lengths are words split at white space. Rows alike in all four are counted first
and dealt in lots of at most LOT, so a row repeated any number of times is spread over groups too.

Defined results: null sources are one source; null and empty texts have length 0 and take a place like others; rows
repeated are packed each (in different bins, being one cluster); a null doc_id is packed like others; texts longer than a bin
are divided, never cut short; columns beyond doc_id, text and source are neither read nor in the way; an empty table gives
no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks_of, body, cut, lean, partitions, read_documents, row_key, scratch, text_buffers
from .simhash import near_components

CAPACITY = 2048
PER_SOURCE = 2
GROUP = 8192
LOT = 256
SLICE = 1 << 21  # bytes of text worked on at once

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def pack(items: list[tuple], capacity: int = CAPACITY, per_source: int = PER_SOURCE) -> list[tuple[int, int]]:
    """(bin, offset) of each item (length, source bit, cluster bit), in the order given; lengths are at most the capacity."""
    order: list[tuple[int, int]] = []  # (what is left, bin)
    clusters: list[int] = []
    sources: list[list[int]] = []
    out = []
    for length, source, cluster in items:
        has, same = 1 << source, 1 << cluster
        at = bisect_left(order, (length, -1))
        while at < len(order):
            b = order[at][1]
            if not clusters[b] & same and not sources[b][-1] & has:
                break
            at += 1
        if at < len(order):
            left, b = order.pop(at)
        else:
            left, b = capacity, len(clusters)
            clusters.append(0)
            sources.append([0] * per_source)
        clusters[b] |= same
        for k, held in enumerate(sources[b]):
            if not held & has:
                sources[b][k] = held | has
                break
        insort(order, (left - length, b))
        out.append((b, capacity - left))
    return out


def word_counts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words of each of the texts that stand end to end; a word ends with its text."""
    inside = ~_SPACE[raw]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    begin = offsets[:-1][np.diff(offsets) > 0]
    starts[begin] = inside[begin]
    return np.diff(np.searchsorted(np.flatnonzero(starts), offsets))


@lean
def _lengths(batches):
    """Rows with texts -> the same rows with the texts' lengths."""
    for batch in batches:
        raw, offsets = text_buffers(batch.column("text"))
        counts = [word_counts(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in blocks_of(offsets, SLICE)]
        names = ["doc_id", "source", "key"]
        length = pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), length], names=[*names, "length"])


def _pack_group(capacity: int, per_source: int):
    def run(key, table):
        rows = [r for r in table.to_pylist() for _ in range(min(LOT, r["n"] - LOT * r["lot"]))]
        rows.sort(key=lambda r: (-r["length"], -1 if r["doc_id"] is None else r["doc_id"], r["cluster"], r["source"]))
        names: dict = {}
        groups: dict = {}
        out, items = [], []
        whole = 0
        for r in rows:
            full, rest = divmod(r["length"], capacity)
            if full and not rest:
                full, rest = full - 1, capacity
            for part in range(full):
                out.append((r["doc_id"], part, capacity, -1 - whole, 0))
                whole += 1
            items.append((rest, names.setdefault(r["source"], len(names)), groups.setdefault(r["cluster"], len(groups)), r["doc_id"], full))
        items.sort(key=lambda x: -x[0])
        placed = pack([x[:3] for x in items], capacity, per_source)
        bins = max((b for b, _ in placed), default=-1) + 1
        out = [(d, p, n, bins - 1 - b, o) for d, p, n, b, o in out]
        out += [(d, part, n, b, o) for (n, _, _, d, part), (b, o) in zip(items, placed)]
        base = key[0].as_py() << 32
        fill: dict[int, int] = {}
        for _, _, n, b, _ in out:
            fill[b] = fill.get(b, 0) + n
        columns = list(zip(*[(d, p, n, base + b, o, fill[b]) for d, p, n, b, o in out]))
        names_out = ["doc_id", "part", "length", "bin_id", "offset", "bin_fill"]
        return pa.table({k: pa.array(list(c), pa.int64()) for k, c in zip(names_out, columns)})

    return run


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, per_source: int = PER_SOURCE, clusters: DataFrame | None = None) -> DataFrame:
    """(doc_id, part, length, bin_id, offset, bin_fill): a row for each part of each document.

    clusters: (key, cluster) with key as common.row_key() makes it; a row without one is a cluster of its own text.
    """
    with scratch(docs.sparkSession):
        lots = _lots(docs, near_components(docs).select("key", F.col("root").alias("cluster")) if clusters is None else clusters)
    groups = max(1, -(-(lots.agg(F.sum("n")).first()[0] or 0) // GROUP))
    lots = lots.withColumn("lot", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / LOT))))
    dealt = lots.withColumn("group", F.pmod(F.xxhash64("doc_id", "cluster", "lot"), F.lit(groups)))
    schema = "doc_id long, part long, length long, bin_id long, offset long, bin_fill long"
    return dealt.repartition(max(partitions(docs.sparkSession), 1), "group").groupBy("group").applyInArrow(_pack_group(capacity, per_source), schema)


def _lots(docs: DataFrame, clusters: DataFrame) -> DataFrame:
    """(doc_id, source, cluster, length, n): rows alike, counted."""
    items = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        row_key().alias("key"), body().alias("text"),
    ).mapInArrow(_lengths, "doc_id long, source string, key long, length long")
    lots = items.groupBy("doc_id", "source", "key", "length").agg(F.count(F.lit(1)).alias("n"))
    lots = lots.join(clusters.groupBy("key").agg(F.min("cluster").alias("cluster")), "key", "left").withColumn("cluster", F.coalesce("cluster", "key"))
    return cut(lots.groupBy("doc_id", "source", "cluster", "length").agg(F.sum("n").alias("n")), keep=True)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_documents(spark, sf_dir))
