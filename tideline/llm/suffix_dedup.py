"""Repeated passages by a depth-limited radix sort of suffixes, most significant digit first.

Two suffixes share a passage of `threshold` tokens exactly when they agree through that depth, so suffixes are divided by one
digit (a run of tokens) after the other, a group of one leaves at once, and nothing is read beyond the depth. Tokens are bytes
(op7) or words; a digit is known by a 64-bit name, and suffixes meet only where the names of all their digits agree.

The suffix array is sparse. Of REACH neighbouring suffixes only one is sorted, the anchor: the one with the smallest hash of its
first few tokens, so equal passages have their anchors at equal places. It stands for the windows that begin up to REACH - 1 tokens
before it, which all hold its first threshold - REACH + 1 tokens. The passes:

1. the leading digit of each anchor suffix; suffixes whose leading digit stands nowhere else leave;
2. the second digit, up to the depth that all windows of an anchor share;
3. the last digit: the tokens before and after that, over all windows of an anchor. Where it repeats whole, so does every
   window; where the suffixes of a group differ in it, one of each kind is divided window by window.

The groups left are exactly the repeated windows. Groups are counted with partial aggregates and joined, so a passage that a third
of the corpus shares is never gathered. A false match needs two windows that agree in some digits and whose names
collide in all the others, so only pairs within one group are at risk, at 2**-64 each.

Defined results: null and empty texts have no tokens and keep the hash of nothing; texts shorter than the threshold lose
nothing; texts equal in at least that many tokens lose all they share, in every copy, rows repeated with one doc_id included; a
null doc_id is a document like others; columns beyond doc_id and text are carried along, whatever their names; an empty
table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_CODES, anchors, blocks_of, body, cut, lean, marked, marks, mix, prefixes, read_documents, scratch, spans_hash, text_buffers
from .repeats import NO_ID, SLICE, apply_runs, covered, row_id
from .window_dedup import word_codes

THRESHOLD = 400  # bytes
PASSAGE = 50  # words: what a corpus loses by without_repeats
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Tokens:
    """How a text becomes tokens, and how runs of them are cut out of it."""

    codes: Callable  # (raw bytes, offsets) -> (code of each token, first token of each text)
    without: Callable  # (bytes of a text, begin, end of the runs) -> the bytes that are kept


def _bytes(raw, offsets):
    return BYTE_CODES[raw], offsets


def _without_bytes(text: bytes, begin, end) -> bytes:
    out, at = [], 0
    for a, b in zip(begin.tolist(), end.tolist()):
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def _without_words(text: bytes, begin, end) -> bytes:
    """White space before a run stays, that after it goes."""
    places = np.array([m.start() for m in _WORD.finditer(text)] + [len(text)], np.int64)
    return _without_bytes(text, places[begin], places[end])


BYTES = Tokens(_bytes, _without_bytes)
WORDS = Tokens(word_codes, _without_words)


@dataclass(frozen=True)
class Depths:
    """The depth of the sort, and what follows from it: one anchor in `reach` suffixes, chosen by `gram` tokens; the first digit."""

    threshold: int

    @property
    def reach(self) -> int:
        return max(1, self.threshold * 4 // 25)

    @property
    def gram(self) -> int:
        return max(1, self.threshold // 25)

    @property
    def lead(self) -> int:
        return max(1, self.threshold * 3 // 25)

    @property
    def shared(self) -> int:
        return self.threshold - self.reach + 1


def anchor_suffixes(codes: np.ndarray, first: np.ndarray, d: Depths):
    """(text, anchor, first window, number of windows) of the sorted suffixes of texts laid end to end, and the texts' prefix sums."""
    if len(codes) < d.threshold:
        return None
    prefix = prefixes(codes)
    place = anchors(prefix, len(codes), d.gram, d.reach)
    at = np.arange(len(codes) - d.threshold + 1)
    text = np.searchsorted(first, at, "right") - 1
    at = at[at + d.threshold <= first[text + 1]]
    if not len(at):
        return None
    place = place[at]
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (at[1:] != at[:-1] + 1)
    begin = np.flatnonzero(new)
    lo = at[begin]
    return np.searchsorted(first, lo, "right") - 1, place[begin], lo, np.diff(np.append(begin, len(at))), prefix


def _sliced(batch, tokens: Tokens):
    raw, offsets = text_buffers(batch.column("text"))
    for i, j in blocks_of(offsets, SLICE):
        yield i, j, *tokens.codes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


def _leading_digits(tokens: Tokens, d: Depths):
    @lean
    def run(batches):
        for batch in batches:
            for _, _, codes, first in _sliced(batch, tokens):
                if found := anchor_suffixes(codes, first, d):
                    _, place, _, _, prefix = found
                    yield pa.RecordBatch.from_arrays([pa.array(spans_hash(prefix, place, place + d.lead).view(np.int64))], names=["d1"])

    return run


def _digits(tokens: Tokens, d: Depths):
    @lean
    def run(batches):
        for batch in batches:
            doc, key = batch.column("doc_id"), batch.column("key")
            for i, _, codes, first in _sliced(batch, tokens):
                if found := anchor_suffixes(codes, first, d):
                    text, place, lo, n, prefix = found
                    d1 = spans_hash(prefix, place, place + d.lead)
                    d2 = spans_hash(prefix, place + d.lead, place + d.shared)
                    d3 = spans_hash(prefix, lo, lo + n - 1 + d.threshold) ^ mix((place - lo).astype(np.uint64) + np.uint64(1 << 32))
                    row = pa.array(text + i)
                    arrays = [*(pa.array(x.view(np.int64)) for x in (d1, d2, d3)), doc.take(row), key.take(row), pa.array(lo - first[text]), pa.array(n.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(arrays, names=["d1", "d2", "d3", "doc_id", "key", "lo", "n"])

    return run


def _windows(tokens: Tokens, d: Depths):
    """Texts with spans (lo, n, many, d2) -> a row for each window in them: its group, the name of the whole window, its place."""

    @lean
    def run(batches):
        for batch in batches:
            doc, key, spans = batch.column("doc_id"), batch.column("key"), batch.column("spans")
            ends = spans.offsets.to_numpy()
            fields = {c: spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("lo", "n", "many", "d2")}
            for i, j, codes, first in _sliced(batch, tokens):
                lo, n, many, d2 = (fields[c][ends[i] : ends[j]] for c in ("lo", "n", "many", "d2"))
                if not n.sum():
                    continue
                of = np.repeat(np.arange(len(n)), n)
                text = np.repeat(np.arange(j - i), np.diff(ends[i : j + 1]))[of]
                at = lo[of].astype(np.int64) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
                begin = first[text] + at
                name = spans_hash(prefixes(codes), begin, begin + d.threshold)
                row = pa.array(text + i)
                arrays = [pa.array(d2[of]), pa.array(name.view(np.int64)), doc.take(row), key.take(row), pa.array(at), pa.array(many[of])]
                yield pa.RecordBatch.from_arrays(arrays, names=["d2", "name", "doc_id", "key", "lo", "many"])

    return run


def repeated_windows(docs: DataFrame, ids: list[Column], tokens: Tokens = BYTES, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, key, lo, n): runs of starts of the windows of `threshold` tokens that also start elsewhere. ids: row_id(docs)."""
    d = Depths(threshold)
    place = "doc_id long, key binary, lo long"
    texts = docs.select(*ids, body().alias("text"))
    # first pass
    leading = texts.select("text").mapInArrow(_leading_digits(tokens, d), "d1 long").groupBy("d1").agg(F.count(F.lit(1)).alias("c"))
    leading = cut(leading.filter("c > 1").select("d1"))  # read anew, so that a hot digit's side of the join can be split
    suffixes = texts.mapInArrow(_digits(tokens, d), f"d1 long, d2 long, d3 long, {place}, n int")
    suffixes = cut(suffixes.join(leading.hint("merge"), "d1", "left_semi"))
    # second and third pass: a group goes on where its suffixes differ in the last digit, one of each kind for all
    kinds = suffixes.groupBy("d1", "d2", "d3").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("doc_id", "key", "lo", "n")).alias("one"))
    kinds = cut(kinds)
    open_groups = cut(kinds.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("d1", "d2"))
    again = kinds.filter("c > 1").select("d1", "d2", "d3")
    settled = suffixes.join(again, ["d1", "d2", "d3"], "left_semi").select("doc_id", "key", "lo", "n")
    ones = kinds.join(open_groups, ["d1", "d2"], "left_semi").select("d2", "one.*", F.when(F.col("c") > 1, 2).otherwise(1).cast("int").alias("many"))
    of_text = ones.groupBy("doc_id", "key").agg(F.collect_list(F.struct("lo", "n", "many", "d2")).alias("spans"))
    once = texts.join(of_text, ["doc_id", "key"]).select("doc_id", "key", "text", "spans").dropDuplicates(["doc_id", "key"])  # rows alike share a verdict
    windows = cut(once.mapInArrow(_windows(tokens, d), f"d2 long, name long, {place}, many int"))
    repeated = cut(windows.groupBy("d2", "name").agg(F.sum("many").alias("c")).filter("c > 1").select("d2", "name"))
    found = windows.join(repeated, ["d2", "name"], "left_semi").select("doc_id", "key", "lo", F.lit(1).alias("n"))
    return settled.unionByName(found)


def repeated_passages(docs: DataFrame, ids: list[Column], tokens: Tokens = BYTES, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, key, n_removed, n_spans, kept_text, kept_sha256) of the documents with repeated passages; counts are of tokens."""
    return apply_runs(docs, cut(repeated_windows(docs, ids, tokens, threshold)), threshold, tokens.without, ids)


def digests(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    ids = row_id(docs)
    with scratch(docs.sparkSession):
        changed = cut(repeated_passages(docs, ids, BYTES, threshold).drop("kept_text"), keep=True)
    whole = docs.select(*ids, F.octet_length(body()).cast("long").alias("n_bytes"), F.sha2(body(), 256).alias("whole_sha256"))
    return whole.join(changed, ["doc_id", "key"], "left").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def _cut_passages(tokens: Tokens, threshold: int):
    """Texts with the runs (lo, n) of starts of their repeated windows -> what is kept of them; a row without runs gives null."""

    @F.arrow_udf("string")
    @lean
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, runs in batches:
            los, counts = (runs.values.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in ("lo", "n"))
            ends, kept = runs.offsets.to_numpy(), []
            for i, text in enumerate(texts.cast(pa.large_binary())):
                if not text.is_valid:
                    kept.append(None)
                    continue
                begin, end = covered(los[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]], threshold)
                kept.append(tokens.without(text.as_py(), begin, end).decode(errors="ignore"))
            yield pa.array(kept, pa.string())

    return run


def without_repeats(docs: DataFrame, tokens: Tokens = WORDS, threshold: int = PASSAGE) -> DataFrame:
    """The documents with repeated passages cut out of text (code points cut in half go too) and n_chars counted anew.

    Only rows that may have runs are moved, once, to be joined to them; only texts with runs go to Python.
    """
    ids, named = row_id(docs), ("__tl_id", "__tl_key")
    with scratch(docs.sparkSession):
        runs = cut(repeated_windows(docs, ids, tokens, threshold).withColumnsRenamed(dict(zip(("doc_id", "key"), named))), keep=True)
        with_runs = marks(runs, *named, keep=True)
    of_text = runs.groupBy(*named).agg(F.collect_set(F.struct("lo", "n")).alias("__tl_runs"))  # rows alike add nothing
    rows = docs.withColumns(dict(zip(named, ids)))
    some = rows.filter(marked(with_runs, *named)).join(of_text, [*named], "left")
    loses = F.col("__tl_runs").isNotNull()
    some = some.withColumn("__tl_kept", _cut_passages(tokens, threshold)(F.when(loses, body()), "__tl_runs"))
    some = some.withColumn("text", F.coalesce("__tl_kept", "text"))
    every = some.select(docs.columns).unionByName(rows.filter(~marked(with_runs, *named)).select(docs.columns))
    return every.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_documents(spark, sf_dir))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), s AS (
  SELECT doc_id, b, unnest(range(1, octet_length(b) - 398)) AS pos FROM d WHERE octet_length(b) >= 400
), h AS (
  SELECT doc_id, pos, md5(b[pos:pos + 399]) AS h FROM s
), again AS (
  SELECT h FROM h GROUP BY h HAVING count(*) > 1
), w AS (
  SELECT doc_id, pos, pos - lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS step FROM h SEMI JOIN again USING (h)
), numbered AS (
  SELECT doc_id, pos, count(*) FILTER (WHERE step IS NULL OR step > 400) OVER (PARTITION BY doc_id ORDER BY pos) AS run FROM w
), runs AS (
  SELECT doc_id, run, min(pos) AS a, max(pos) + 400 AS z FROM numbered GROUP BY doc_id, run
), pieces AS (
  SELECT doc_id, run, hex(b[coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY run), 1):a - 1]) AS piece, z - a AS gone FROM runs JOIN d USING (doc_id)
), heads AS (
  SELECT doc_id, string_agg(piece, '' ORDER BY run) AS kept, sum(gone) AS n_removed, count(*) AS n_spans FROM pieces GROUP BY doc_id
), tails AS (
  SELECT doc_id, hex(b[max(z):]) AS piece FROM runs JOIN d USING (doc_id) GROUP BY doc_id, b
)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       CASE WHEN n_spans IS NULL THEN sha256(b) ELSE sha256(unhex(kept || tails.piece)) END AS kept_sha256
FROM d LEFT JOIN heads USING (doc_id) LEFT JOIN tails USING (doc_id)
"""
