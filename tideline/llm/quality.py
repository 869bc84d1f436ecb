"""Quality classifier learned from positive and unlabelled texts.

Only trusted positives (labels.quality = 1) and unlabelled web text are used: the non-negative unbiased risk
    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))
is minimised for a linear logistic model, so that the unlabelled texts stand for the rejected class without being taken for it.
The class prior is estimated from the same two samples: a first model ranks texts, and the prior is the least ratio of the
two samples' mass above a threshold, over thresholds that leave enough of both.

Features are taken from whole texts, in one pass over their bytes: shares of pairs of neighbouring character classes, and
word statistics (length, repetition, variety). Labels are read from a bounded sample (SAMPLE positives and SAMPLE unlabelled
texts, chosen by a hash of doc_id, so the same at every run; one row of each doc_id); scoring is a pass without a shuffle.

Defined results: null and empty texts have zero features and are scored like any other text; rows repeated are scored alike; a
null doc_id is in no fold and has no label; an empty table gives an empty result; without any positive every score is
0.5 and no document is rejected; columns beyond doc_id and text are carried along, whatever their names; texts of any length are
read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks_of, body, lean, read_documents, smallest_hashes, text_buffers
from .window_dedup import word_codes

SAMPLE = 8000  # positives, and unlabelled texts, that the fit sees at most
THRESHOLD = 0.7
FOLDS, HELD_OUT = 4, 2
STEPS, RATE, PENALTY, SHRINK = 600, 0.05, 1e-3, 3.0  # SHRINK: more penalty where there are few positives
SOFTEN = 0.01  # added to each feature's deviation, so that rare characters weigh little

# Classes of bytes: lower case, upper case, digit, space, line end, full stop, comma, ! and ?, |, other ASCII, beyond ASCII.
_CLASSES = 11
_CLASS = np.full(256, 9, np.int64)
for _i, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n\v\f", b".", b",", b"!?", b"|")):
    _CLASS[list(_set)] = _i
_CLASS[128:] = 10
WIDTH = _CLASSES * _CLASSES + 7


def features(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of WIDTH numbers for each of the texts laid end to end."""
    n = len(offsets) - 1
    out = np.zeros((n, WIDTH), np.float32)
    sizes = np.diff(offsets)
    if not len(raw):
        return out
    kind = _CLASS[raw]
    pair = kind[:-1] * _CLASSES + kind[1:]
    for i in range(n):
        a, b = offsets[i], offsets[i + 1]
        if b - a > 1:
            out[i, : _CLASSES * _CLASSES] = np.bincount(pair[a : b - 1], minlength=_CLASSES * _CLASSES) / (b - a - 1)
    words, first = word_codes(raw, offsets)
    count = np.diff(first)
    some = np.maximum(count, 1)
    doc = np.repeat(np.arange(n), count)
    again = np.zeros(len(words), bool)
    again[1:] = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1])
    pairs = np.zeros(len(words), bool)
    pairs[2:] = (words[2:] == words[:-2]) & (doc[2:] == doc[:-2])
    marks = np.uint64(max(1, int(n).bit_length()))
    distinct = np.unique((doc.astype(np.uint64) << (np.uint64(64) - marks)) | (words >> marks))
    variety = np.bincount((distinct >> (np.uint64(64) - marks)).astype(np.int64), minlength=n)[:n]
    lines = np.add.reduceat(np.append(kind == 4, False).astype(np.int64), np.minimum(offsets[:-1], len(raw)))
    lines = np.where(sizes > 0, lines, 0)
    extra = (
        np.log1p(sizes), sizes / some / 10, np.bincount(doc[again], minlength=n)[:n] / some, np.bincount(doc[pairs], minlength=n)[:n] / some,
        variety / some, np.log1p(count), lines / some,
    )
    out[:, _CLASSES * _CLASSES :] = np.stack(extra, axis=1)
    out[sizes == 0] = 0
    return out


def _batches(batch):
    raw, offsets = text_buffers(batch.column("text"))
    for i, j in blocks_of(offsets, 1 << 21):
        yield i, j, features(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])


@lean
def _extract(batches):
    for batch in batches:
        rows = [f for _, _, f in _batches(batch)]
        flat = np.concatenate(rows) if rows else np.zeros((0, WIDTH), np.float32)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("positive"), pa.array(list(flat), pa.list_(pa.float32()))], names=["doc_id", "positive", "x"])


def fold() -> Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled: the least ratio of the two upper tails, each ratio plus two standard errors.

    Above any score the unlabelled hold at least prior times what the positives hold. The error keeps the least of many
    ratios from being a matter of chance where the tails are small.
    """
    positive, unlabelled = np.sort(positive), np.sort(unlabelled)
    n, m = len(positive), len(unlabelled)
    cuts = np.quantile(positive, np.linspace(0.0, 0.9, 181))
    above_p = np.maximum(1 - np.searchsorted(positive, cuts) / n, 1 / n)
    above_u = np.maximum(1 - np.searchsorted(unlabelled, cuts) / m, 1 / m)
    ratio = above_u / above_p
    error = ratio * np.sqrt((1 - above_p) / (n * above_p) + (1 - above_u) / (m * above_u))
    return float(np.clip((ratio + 2 * error).min(), 0.05, 0.99))


def fit_risk(p: np.ndarray, u: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Weights (the last one is the constant) minimising the non-negative risk by Adam on whole samples."""
    p, u = np.column_stack([p, np.ones(len(p))]), np.column_stack([u, np.ones(len(u))])
    w, m, v = np.zeros(p.shape[1]), np.zeros(p.shape[1]), np.zeros(p.shape[1])

    def sigmoid(x):
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    for step in range(1, steps + 1):
        gp, gu = p @ w, u @ w
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        slope = u.T @ sigmoid(gu) / len(u) - prior * (p.T @ sigmoid(gp)) / len(p)
        if negative >= 0:
            grad = -prior * (p.T @ sigmoid(-gp)) / len(p) + slope
        else:  # the negative part fell below zero: step back on it alone
            grad = -slope
        grad[:-1] += (PENALTY + SHRINK / len(p)) * w[:-1]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict | None:
    """The model, from labels outside the held-out fold and unlabelled texts outside it."""
    known = labels.filter(F.coalesce(fold(), F.lit(0)) != HELD_OUT).filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"))
    positives = smallest_hashes(known, sample).withColumn("positive", F.lit(True))
    free = docs.filter(F.coalesce(fold(), F.lit(0)) != HELD_OUT).select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id is not null")
    others = smallest_hashes(free, sample, "unlabelled").withColumn("positive", F.lit(False))
    chosen = positives.unionByName(others)  # at most 2 * sample ids, whatever the corpus
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text")).join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id", "positive", "text").mapInArrow(_extract, "doc_id long, positive boolean, x array<float>")
    rows = found.groupBy("doc_id", "positive").agg(F.min("x").alias("x")).toArrow()  # one of the rows that repeat an id
    x = np.frombuffer(rows.column("x").combine_chunks().values.to_numpy(zero_copy_only=False), np.float32).reshape(-1, WIDTH) if len(rows) else np.zeros((0, WIDTH))
    sign = rows.column("positive").to_numpy().astype(bool)
    if not sign.any() or sign.all():
        return None
    mean, scale = x.mean(0), x.std(0) + SOFTEN
    z = np.clip((x - mean) / scale, -8, 8).astype(np.float64)
    p, u = z[sign], z[~sign]
    rough = fit_risk(p, u, 0.5, 200)
    prior = estimate_prior(p @ rough[:-1], u @ rough[:-1])
    return {"w": fit_risk(p, u, prior), "mean": mean, "scale": scale, "prior": prior}


def _score(model: dict | None):
    @lean
    def run(batches):
        for batch in batches:
            scores = np.full(batch.num_rows, 0.5)
            if model is not None:
                w = model["w"]
                for i, j, x in _batches(batch):
                    g = np.clip((x - model["mean"]) / model["scale"], -8, 8) @ w[:-1] + w[-1]
                    scores[i:j] = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pa.array(scores)], names=[*others, "score"])

    return run


def score(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, score) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), body().alias("text"))
    return rows.mapInArrow(_score(model), "doc_id long, score double")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with their own columns; all of them where nothing could be learned."""
    model, columns = fit(docs, labels), docs.columns
    if model is None:
        return docs

    @lean
    def keep(batches):
        for batch in batches:
            scored = next(iter(_score(model)([pa.RecordBatch.from_arrays([batch.column("text")], names=["text"])])))
            mask = pa.array(scored.column("score").to_numpy() >= THRESHOLD)
            yield batch.filter(mask)

    return docs.mapInArrow(keep, docs.schema).select(columns)


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score(docs, fit(docs, labels))
    held = F.coalesce(fold(), F.lit(0)) == HELD_OUT
    return scored.select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"))
