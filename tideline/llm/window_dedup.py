"""Repeated word passages by level-wise doubling.

Words become numbers (a hash each); a window is LENGTH consecutive words. The first level looks at FIRST words at each
window's anchor; where they are repeated, and only there, the windows around them are extended to twice that length, and so on
to LENGTH, each level keeping the windows whose parts all repeat. Where all extensions of a repeated start agree they are settled
together and need no further level. Of equal windows the earliest (smallest doc_id, then earliest start) is kept. See
repeats.py.

Defined results: null and empty texts have no words; fewer than LENGTH words lose nothing; rows with one doc_id, or null, are
ordered by the start alone, so a window that stands at one place in two of them, repeated rows or different texts, is earlier in neither
and stays in both, unless an earlier one is elsewhere; a null doc_id comes first; columns beyond doc_id and text are
neither read nor in the way; an empty table gives an empty result; texts of any length are read whole.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BYTE_CODES, body, cut, prefixes, read_documents, scratch, spans_hash
from .repeats import NO_ID, Windows, apply_runs, repeated_windows, row_id

LENGTH = 20
FIRST = 5
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_codes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For texts laid end to end: a hash of each word, and each text's first word."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    mask = ~_SPACE[raw]
    first = np.zeros(len(mask) + 1, bool)
    first[offsets[:-1]] = True
    start, stop = mask & first[:-1], mask & first[1:]
    start[1:] |= mask[1:] & ~mask[:-1]
    start[0] = mask[0]
    stop[:-1] |= mask[:-1] & ~mask[1:]
    stop[-1] = mask[-1]
    begins, ends = np.flatnonzero(start), np.flatnonzero(stop) + 1
    return spans_hash(prefixes(BYTE_CODES[raw]), begins, ends), np.searchsorted(begins, offsets)


def _cut_words(text: bytes, begin, end) -> bytes:
    words = _WORD.findall(text)
    out, at = [], 0
    for a, b in zip(begin.tolist(), end.tolist()):
        out.extend(words[at:a])
        at = b
    return b" ".join([*out, *words[at:]])


def windows(length: int = LENGTH, first: int = FIRST) -> Windows:
    levels = []
    while (first * 2 ** (len(levels) + 1)) < length:
        levels.append(first * 2 ** (len(levels) + 1))
    return Windows(length, length - first + 1, first, word_codes, tuple(levels))


def repeated_words(docs: DataFrame, ids: list[Column], length: int = LENGTH, first: int = FIRST) -> DataFrame:
    """(doc_id, key, n_removed, n_spans, kept_text, kept_sha256) of the documents that lose words."""
    w = windows(length, first)
    return apply_runs(docs, cut(repeated_windows(docs, w, True, ids)), w.length, _cut_words, ids)


def digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one space)."""
    ids = row_id(docs)
    with scratch(docs.sparkSession):
        changed = cut(repeated_words(docs, ids, length).drop("kept_text"), keep=True)
    line = F.trim(F.regexp_replace(body(), r"[\x20\x09-\x0D]+", " "))
    words = F.when(line == "", F.lit(0)).otherwise(F.length(line) - F.length(F.replace(line, F.lit(" "))) + 1)
    whole = docs.select(*ids, words.cast("long").alias("n_words"), F.sha2(line, 256).alias("whole_sha256"))
    return whole.join(changed, ["doc_id", "key"], "left").select(
        F.nullif("doc_id", F.lit(NO_ID)).alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )


def op9_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_documents(spark, sf_dir))


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS pos FROM w WHERE len(words) >= 20
), h AS (
  SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 19], ' ')) AS h FROM s
), r AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS k FROM h
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM r WHERE k > 1
), each AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM w
), left_over AS (
  SELECT e.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept
  FROM each e ANTI JOIN gone g USING (doc_id, pos) GROUP BY e.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN left_over l USING (doc_id)
"""
