"""Repeated windows of a fixed length, in whole corpora, without moving every window.

The level-wise deduplicator of passages is built on this. A window is `length` consecutive
units of one text. Each window is charged to its anchor, the first place in it with the smallest hash of a short gram;
equal windows have their anchors at equal offsets. Neighbouring windows with one anchor, cut at multiples of `width` of
that offset, form a block. All windows of a block share its core (length - width + 1 units) and lie in its hull, so

- a window can only repeat where its block's core repeats: blocks with an unrepeated core leave after the first pass;
- where all blocks of one core have one hull, every window of them repeats, window by window: they are settled;
- of the other cores, one representative per distinct hull goes on: its windows pass through the levels, if there are any (a
  window stays while its parts of that shorter length all repeat), and those left are compared one by one.

Groups are counted with partial aggregates and joined, so a core that a third of the corpus shares is never gathered.
Rows are identified by doc_id and, where ids repeat, a 128-bit hash of their text; rows alike in both share one verdict.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import anchors, blocks_of, body, cut, lean, mix, prefixes, spans_hash, text_buffers

SLICE = 1 << 21  # bytes of text worked on at once


@dataclass(frozen=True)
class Windows:
    """length of a window, width of a block, length of the gram that places anchors; how a text becomes units."""

    length: int
    width: int
    gram: int
    units: Callable  # (raw bytes, offsets) -> (code of each unit, first unit of each text)
    levels: tuple[int, ...] = ()  # shorter lengths, whose repeats are extended before single windows are compared


NO_ID = -(1 << 63)  # stands for a null doc_id, so that ids compare and join as plain numbers


def row_id(docs: DataFrame) -> list[Column]:
    """Columns that identify a row: its doc_id and, where any doc_id or null stands in several rows, 128 bits of its text's hash.

    Rows alike in both are one to every operator here.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id")
    repeated = docs.select(doc_id).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    key = F.lit(b"") if repeated.isEmpty() else F.unhex(F.md5(body()))
    return [doc_id, key.alias("key")]


def _blocks(codes: np.ndarray, first: np.ndarray, w: Windows):
    """(text, core, hull, first start, starts) of the blocks of texts laid end to end."""
    n = len(codes)
    if n < w.length:
        return None
    prefix = prefixes(codes)
    anchor = anchors(prefix, n, w.gram, w.length - w.gram + 1)
    at = np.arange(len(anchor))
    text = np.searchsorted(first, at, "right") - 1
    whole = at + w.length <= first[text + 1]
    at, anchor, text = at[whole], anchor[whole], text[whole]
    if not len(at):
        return None
    part = (anchor - at) // w.width
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    count = np.diff(np.append(begin, len(at)))
    lo, part, anchor = at[begin], part[begin], anchor[begin]
    core_at = anchor - part * w.width
    core = spans_hash(prefix, core_at, core_at + w.length - w.width + 1) ^ mix(part.astype(np.uint64))
    hull = spans_hash(prefix, lo, lo + count - 1 + w.length) ^ mix((anchor - lo).astype(np.uint64) + np.uint64(1 << 32))
    return text[begin], core, hull, lo - first[text[begin]], count


def _block_rows(w: Windows, only_core: bool):
    @lean
    def run(batches):
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            if not only_core:
                doc, key = batch.column("doc_id"), batch.column("key")
            for i, j in blocks_of(offsets, SLICE):
                found = _blocks(*w.units(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), w)
                if found is None:
                    continue
                text, core, hull, lo, count = found
                core = pa.array(core.view(np.int64))
                if only_core:
                    yield pa.RecordBatch.from_arrays([core], names=["core"])
                    continue
                row = pa.array(text + i)
                arrays = [core, pa.array(hull.view(np.int64)), doc.take(row), key.take(row), pa.array(lo), pa.array(count.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(arrays, names=["core", "hull", "doc_id", "key", "lo", "n"])

    return run


def _expanded(batch, i: int, j: int):
    """(row, start, many) of each single window in the spans of rows i to j."""
    spans = batch.column("spans")
    ends = spans.offsets.to_numpy()
    los, counts, many = (spans.values.field(k).to_numpy(zero_copy_only=False)[ends[i] : ends[j]].astype(np.int64) for k in ("lo", "n", "many"))
    row = np.repeat(np.repeat(np.arange(i, j), np.diff(ends[i : j + 1])), counts)
    step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return row, np.repeat(los, counts) + step, np.repeat(many, counts)


def _parts(w: Windows, length: int) -> list[int]:
    """Where in a window its parts of a shorter length begin, so that they cover it."""
    return sorted({*range(0, w.length - length + 1, length), w.length - length})


def _window_rows(w: Windows, length: int):
    """Texts with their spans -> a row per distinct part of their windows: hash, place, and 2 if it is known to repeat, else 1."""

    @lean
    def run(batches):
        for batch in batches:
            raw, offsets = text_buffers(batch.column("text"))
            doc, key = batch.column("doc_id"), batch.column("key")
            for i, j in blocks_of(offsets, SLICE):
                codes, first = w.units(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                row, lo, many = _expanded(batch, i, j)
                if not len(row):
                    continue
                steps = _parts(w, length)
                at = np.concatenate([lo + first[row - i] + k for k in steps])
                many = np.tile(many, len(steps))
                order = np.lexsort((-many, at))
                at, many = at[order], many[order]
                new = np.ones(len(at), bool)
                new[1:] = at[1:] != at[:-1]
                at, many = at[new], many[new]
                h = spans_hash(prefixes(codes), at, at + length)
                text = np.searchsorted(first, at, "right") - 1
                where = pa.array(text + i)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), doc.take(where), key.take(where), pa.array(at - first[text]), pa.array(many.astype(np.int32))], names=["h", "doc_id", "key", "lo", "many"])

    return run


def _extend(w: Windows, length: int):
    """Texts with spans and the starts of their repeated parts -> the same texts with the windows whose parts all repeat."""
    reach = np.int64(1) << np.int64(40)

    @lean
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            row, lo, many = _expanded(batch, 0, n)
            hits = batch.column("hits")
            ends = hits.offsets.to_numpy()
            known = np.repeat(np.arange(n), np.diff(ends)) * reach + hits.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
            keep = np.ones(len(row), bool)
            for k in _parts(w, length):
                keep &= np.isin(row * reach + lo + k, known)
            row, lo, many = row[keep], lo[keep], many[keep]
            order = np.lexsort((lo, row))
            row, lo, many = row[order], lo[order], many[order]
            new = np.ones(len(row), bool)
            new[1:] = (row[1:] != row[:-1]) | (lo[1:] != lo[:-1] + 1) | (many[1:] != many[:-1])
            begin = np.flatnonzero(new)
            size = np.diff(np.append(begin, len(row)))
            cells = pa.StructArray.from_arrays([pa.array(lo[begin]), pa.array(size.astype(np.int32)), pa.array(many[begin].astype(np.int32))], names=["lo", "n", "many"])
            edges = np.searchsorted(row[begin], np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "key", "text")), pa.ListArray.from_arrays(pa.array(edges), cells)], names=["doc_id", "key", "text", "spans"])

    return run


def repeated_windows(docs: DataFrame, w: Windows, keep_first: bool, ids: list[Column]) -> DataFrame:
    """(doc_id, key, lo, n): starts of windows that repeat, as runs; with keep_first, not the earliest of equal windows.

    Earliest is by doc_id (null first), then by place. ids: row_id(docs).
    """
    texts = docs.select(*ids, body().alias("text"))
    place = "doc_id long, key binary, lo long"
    cores = texts.select("text").mapInArrow(_block_rows(w, True), "core long").groupBy("core").agg(F.count(F.lit(1)).alias("c"))
    cores = cut(cores.filter("c > 1").select("core"))  # read anew, so that a hot core's side of the join can be split
    blocks = texts.mapInArrow(_block_rows(w, False), f"core long, hull long, {place}, n int")
    blocks = cut(blocks.join(cores.hint("merge"), "core", "left_semi"))
    hulls = blocks.groupBy("core", "hull").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "key", "lo", "n")).alias("rep"))
    hulls = cut(hulls)
    mixed = cut(hulls.groupBy("core").agg(F.count(F.lit(1)).alias("hulls")).filter("hulls > 1").select("core"))
    columns = ["doc_id", "key", "lo", "n"]
    # settled by their hulls alone
    common = hulls.filter("c > 1").select("core", "hull", F.col("rep").alias("rep"))
    settled = blocks.join(common, ["core", "hull"])
    if keep_first:
        settled = settled.filter(~((F.col("doc_id") == F.col("rep.doc_id")) & (F.col("lo") == F.col("rep.lo"))))
    settled = settled.select(columns)
    # the others window by window
    reps = hulls.join(mixed, "core", "left_semi").select("rep.*", (F.when(F.col("c") > 1, 2).otherwise(1)).cast("int").alias("many"))
    of_text = reps.groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "n", "many")).alias("spans"))
    # rows alike share a verdict, so one of them is enough here
    once = texts.join(of_text, ["doc_id", "key"]).select("doc_id", "key", "text", "spans").dropDuplicates(["doc_id", "key"])
    hashed = f"h long, {place}, many int"
    for length in w.levels:
        once = cut(once)
        parts = cut(once.mapInArrow(_window_rows(w, length), hashed))
        again = cut(parts.groupBy("h").agg(F.sum("many").alias("c")).filter("c > 1").select("h"))
        hits = parts.join(again, "h", "left_semi").groupBy("doc_id", "key").agg(F.collect_list("lo").alias("hits"))
        once = once.join(hits, ["doc_id", "key"]).select("doc_id", "key", "text", "spans", "hits")
        once = once.mapInArrow(_extend(w, length), "doc_id long, key binary, text string, spans array<struct<lo: long, n: int, many: int>>")
    singles = cut(once.mapInArrow(_window_rows(w, w.length), hashed))
    if keep_first:
        found = cut(singles.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "lo")).alias("rep")).filter("c > 1"))
        found = singles.join(found, "h").filter(~((F.col("doc_id") == F.col("rep.doc_id")) & (F.col("lo") == F.col("rep.lo"))))
    else:
        found = cut(singles.groupBy("h").agg(F.sum("many").alias("c")).filter("c > 1").select("h"))
        found = singles.join(found, "h", "left_semi")
    return settled.unionByName(found.select("doc_id", "key", "lo", F.lit(1).alias("n")))


def covered(los: np.ndarray, counts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [begin, end) of the units that windows starting in the given runs cover."""
    order = np.argsort(los, kind="stable")
    begin, end = los[order], (los + counts - 1 + length)[order]
    reach = np.maximum.accumulate(end)
    new = np.ones(len(begin), bool)
    new[1:] = begin[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return begin[at], reach[np.append(at[1:] - 1, len(begin) - 1)]


def with_runs(docs: DataFrame, runs: DataFrame, ids: list[Column]) -> DataFrame:
    """The affected documents' rows (doc_id, key, text) with their runs, for a function over whole texts."""
    texts = docs.select(*ids, body().alias("text"))
    of_text = runs.groupBy("doc_id", "key").agg(F.collect_set(F.struct("lo", "n")).alias("runs"))  # rows alike add nothing
    return texts.join(of_text, ["doc_id", "key"]).select("doc_id", "key", "text", "runs").dropDuplicates(["doc_id", "key"])


def apply_runs(docs: DataFrame, runs: DataFrame, length: int, cut_out: Callable, ids: list[Column]) -> DataFrame:
    """(doc_id, key, n_removed, n_spans, kept_text, kept_sha256) of the documents that lose something.

    kept_sha256 is of the kept bytes; kept_text leaves out code points that a removed run cut in half.

    cut_out(raw bytes of a text, begin, end of the removed runs in units) -> the bytes that are kept.
    """
    import hashlib

    @lean
    def run(batches):
        for batch in batches:
            runs = batch.column("runs")
            los, counts = (runs.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lo", "n"))
            ends = runs.offsets.to_numpy()
            removed, spans, kept = [], [], []
            for i, text in enumerate(batch.column("text").cast(pa.large_binary())):
                begin, end = covered(los[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]], length)
                removed.append(int((end - begin).sum()))
                spans.append(len(begin))
                kept.append(cut_out(text.as_py(), begin, end))
            arrays = [batch.column("doc_id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array([x.decode(errors="ignore") for x in kept], pa.string()), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "key", "n_removed", "n_spans", "kept_text", "kept_sha256"])

    return with_runs(docs, runs, ids).mapInArrow(run, "doc_id long, key binary, n_removed long, n_spans long, kept_text string, kept_sha256 string")
