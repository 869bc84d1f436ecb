"""Order MinHash fingerprints: sensitive to the order of a text's parts, and so to edit distance.

The k-mers of a text are numbered by occurrence, so that repeats differ. One hash of (k-mer, number) deals them to BINS bins
(one permutation instead of one hash function per entry: 128 functions over every character would be some 100 times the work);
of each bin the TUPLE smallest are selected, put back in text order, and the tuple is hashed to 16 bits. An entry whose
bin has fewer k-mers selects from all k-mers of the text, by a hash function of its own; only short texts have many of these.
The likeness of two fingerprints is the share of equal entries; tests hold it against independent selections.

Each text is also compared to an edited copy of itself that ends with the next document's beginning. Documents are range
partitioned and sorted by doc_id and a hash of their text, so the next document is the next row; only the last row of each partition is completed
afterwards, from as many pairs as there are partitions.

Defined results: null and empty texts have one empty k-mer, so all empty texts are alike (likeness 1); texts shorter than a
k-mer are one k-mer; rows of one doc_id follow each other by a hash of their text; a null doc_id comes first; a single
document is its own next; columns beyond doc_id and text are neither read nor in the way; texts of any length are read whole;
an empty table gives an empty result.

Rows alike in doc_id and text follow each other in one range partition, as each is the next document of the one before.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import body, cut, mix, partitions, prefixes, read_documents, spans_hash
from .repeats import NO_ID, row_id

K = 8
BINS = 128
TUPLE = 2
_ODD = np.uint64(0xD6E8FEB86659FD93)


def signature(codes: np.ndarray, k: int = K, bins: int = BINS, size: int = TUPLE) -> np.ndarray:
    """BINS entries of 16 bits."""
    prefix = prefixes(codes.astype(np.uint64) + np.uint64(1))
    at = np.arange(max(1, len(codes) - k + 1))
    grams = spans_hash(prefix, at, np.minimum(at + k, len(codes)))
    n = len(grams)
    low = np.uint64(max(1, int(n).bit_length()))
    mask = (np.uint64(1) << low) - np.uint64(1)
    place = at.astype(np.uint64)
    ordered = np.sort((grams & ~mask) | place)
    new = np.ones(n, bool)
    new[1:] = (ordered[1:] ^ ordered[:-1]) > mask
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    where = ordered & mask
    keys = mix(grams[where] + number.astype(np.uint64) * _ODD)
    chosen = np.sort((keys & ~mask) | where)
    edges = np.searchsorted(chosen, np.arange(bins, dtype=np.uint64) << np.uint64(64 - int(bins - 1).bit_length()))
    size = min(size, n)
    few = np.flatnonzero(np.append(edges[1:], n) - edges < size)
    picked = chosen[np.minimum(edges[:, None] + np.arange(size), n - 1)]
    own = mix(keys + mix((few.astype(np.uint64) + np.uint64(1)) * _ODD)[:, None])
    picked[few] = np.partition((own & ~mask) | where, size - 1, axis=1)[:, :size]
    values = grams[np.sort((picked & mask).astype(np.int64), axis=1)]
    out = np.zeros(bins, np.uint64)
    for column in values.T:
        out = mix(out * _ODD + column + np.uint64(1))
    return (out >> np.uint64(48)).astype(">u2")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


COLUMNS = "doc_id long, key binary, n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_NAMES = [c.split()[0] for c in COLUMNS.split(", ")]
_TYPES = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
_HEX = ("edited_sha256", "fingerprint", "edited_fingerprint")


def _pair(doc_id, key, text: str, sign: np.ndarray, following: str, next_sign: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    edited_sign = signature(_codes(edited))
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).digest()
    return doc_id, key, len(text), sha, sign.tobytes(), edited_sign.tobytes(), likeness(sign, edited_sign), likeness(sign, next_sign)


def _batch(rows: list[tuple], edges: list[int]) -> pa.RecordBatch:
    columns = [pa.array(x, t) for x, t in zip(zip(*rows), _TYPES)] if rows else [pa.array([], t) for t in _TYPES]
    return pa.RecordBatch.from_arrays([*columns, pa.array(edges, pa.int32())], names=[*_NAMES, "edge"])


def _along(batches):
    """Rows in order of doc_id: each with the next; edge is 1 on a partition's first row, and 2 is added on its last."""
    held, first = None, 1
    for batch in batches:
        rows, edges = [], []
        for doc_id, key, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text"))):
            sign = signature(_codes(text))
            if held is not None:
                rows.append(_pair(*held, text, sign))
                edges.append(first)
                first = 0
            held = (doc_id, key, text, sign)
        yield _batch(rows, edges)
    if held is not None:
        yield _batch([(held[0], held[1], len(held[2]), None, held[3].tobytes(), None, None, None)], [first + 2])


def _ends(batches):
    for batch in batches:
        rows = []
        for doc_id, key, text, following in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "key", "text", "following"))):
            rows.append(_pair(doc_id, key, text, signature(_codes(text)), following, signature(_codes(following))))
        out = _batch(rows, [0] * len(rows))
        yield out.select(_NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, key, n_chars, the two fingerprints, the edited text's hash and the two likenesses."""
    spark = docs.sparkSession
    texts = docs.select(*row_id(docs), body().alias("text"))
    lined = texts.repartitionByRange(partitions(spark), "doc_id", "key").sortWithinPartitions("doc_id", "key")
    done = cut(lined.mapInArrow(_along, f"{COLUMNS}, edge int"))
    # one first and one last row for each partition
    edges = sorted((r.doc_id, bytes(r.key), r.edge) for r in done.filter("edge > 0").select("doc_id", "key", "edge").collect())
    firsts = [(d, k) for d, k, e in edges if e in (1, 3)]
    lasts = [(d, k) for d, k, e in edges if e in (2, 3)]
    pairs = [(i, *last, *firsts[(i + 1) % len(firsts)]) for i, last in enumerate(lasts)]
    ends = F.broadcast(spark.createDataFrame(pairs, "pair int, doc_id long, key binary, next_id long, next_key binary"))
    mine = texts.join(ends.select("pair", "doc_id", "key"), ["doc_id", "key"]).dropDuplicates(["pair"])
    theirs = texts.join(ends.select("pair", F.col("next_id").alias("doc_id"), F.col("next_key").alias("key")), ["doc_id", "key"])
    theirs = theirs.select("pair", F.col("text").alias("following")).dropDuplicates(["pair"])
    rest = mine.join(theirs, "pair").select("doc_id", "key", "text", "following").mapInArrow(_ends, COLUMNS)
    out = done.filter("edge < 2").drop("edge").unionByName(rest)
    shown = {c: F.lower(F.hex(c)) for c in _HEX}  # bytes until here: what is written between the passes stays small
    return out.withColumns(shown | {"doc_id": F.nullif("doc_id", F.lit(NO_ID))})


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_documents(spark, sf_dir)).drop("key")
