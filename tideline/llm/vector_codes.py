"""Vector code compression: product codes of eight parts and sixteen entries, fitted by integer rounds that LAESA pivots prune.

Every component becomes a whole number, so distances are exact and ties go to the lower index wherever a row is
worked on. A few of the first entries of each part position serve as pivots, which stay fixed; each part's distances to them
are computed once and written beside it. In a round only pivot-entry distances are new: by the triangle inequality no entry is
nearer to a part than the difference of their distances to any pivot. Entries are tried in the order of that bound, and a part is
done when the next bound exceeds the best exact distance.

Rows are worked on in their partitions, as columns; a task sends the sums of its entries, (entries x components) numbers, and so
many numbers make up the codebooks, which the driver holds and sends to the next round.

Defined results: vectors that are null, or hold null, NaN or infinite components, are left out, so are those of another length than the
vector of the smallest vec_id; a null vec_id is coded, but not among the first entries; of rows that repeat a vec_id the
smallest vector is; with fewer than 16 ids there are so many entries; rows repeated count as often as they stand; null labels
are one label; an empty table gives an empty result; columns beyond vec_id, embedding and label aren't read. A length that 8 doesn't divide
and components beyond LIMIT, whose squares would not fit, are errors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, lean, scratch

SCALE = 4096
PARTS, ENTRIES, ROUNDS = 8, 16, 6
PIVOTS = 4
LIMIT = 1 << 26  # of a scaled component's size
FEW_LABELS = 10_000  # labels whose sums are broadcast; more are joined by sorting


def kept(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding as doubles) of the rows whose components are all finite."""
    rows = embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    odd = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.filter(F.col("embedding").isNotNull() & ~odd)


def whole(x: np.ndarray) -> np.ndarray:
    out = np.floor(x * SCALE)
    if out.size and np.abs(out).max() > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT / SCALE:.0f}")
    return out.astype(np.int64)


def first_entries(rows: DataFrame, entries: int = ENTRIES) -> np.ndarray | None:
    """The first codebooks (part, entry, component): the vectors of the smallest ids."""
    ids = [r[0] for r in rows.filter("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return None
    chosen = rows.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).orderBy("vec_id").collect()
    size = len(chosen[0].embedding)
    if size % PARTS:
        raise ValueError(f"{size} components can't be cut into {PARTS} equal parts")
    same = [r.embedding for r in chosen if len(r.embedding) == size]
    return whole(np.array(same).reshape(len(same), size)).reshape(len(same), PARTS, size // PARTS).transpose(1, 0, 2)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of a to rows of b."""
    d = a[:, None, :] - b[None, :, :]
    return np.sqrt((d * d).sum(-1).astype(np.float64))


def pick_pivots(books: np.ndarray, many: int = PIVOTS) -> np.ndarray:
    """For each part position, entries far from each other: the first, then always the one farthest from those taken."""
    out = []
    for book in books:
        taken, gap = [0], distances(book, book[:1])[:, 0]
        while len(taken) < min(many, len(book)):
            taken.append(int(gap.argmax()))
            gap = np.minimum(gap, distances(book, book[taken[-1:]])[:, 0])
        out.append(book[taken])
    return np.array(out)


def nearest(x: np.ndarray, near: np.ndarray, book: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(entry, squared distance) of each part in x, and the number of exact distances that it took.

    near and far: distances of the parts and of the entries to the pivots.
    """
    n, k = len(x), len(book)
    bound = np.zeros((n, k))
    for j in range(far.shape[1]):
        np.maximum(bound, np.abs(near[:, j, None] - far[None, :, j]), out=bound)
    slack = 1e-9 * (1 + (near.max() if near.size else 0) + (far.max() if far.size else 0))  # far more than roots are rounded by
    order = np.argsort(bound, axis=1, kind="stable")
    best, entry = np.full(n, np.iinfo(np.int64).max), np.full(n, k)
    open_, tried = np.arange(n), 0
    for rank in range(k):
        e = order[open_, rank]
        go = bound[open_, e] <= np.sqrt(best[open_].astype(np.float64)) + slack
        open_, e = open_[go], e[go]
        if not len(open_):
            break
        tried += len(open_)
        d = x[open_] - book[e]
        d = (d * d).sum(1)
        win = (d < best[open_]) | ((d == best[open_]) & (e < entry[open_]))
        best[open_[win]], entry[open_[win]] = d[win], e[win]
    return entry, best, tried


def _fixed(values: np.ndarray, n: int) -> pa.Array:
    """n rows of equally many bytes as a binary column."""
    raw = np.ascontiguousarray(values).tobytes()
    width = len(raw) // n if n else 0
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(np.arange(n + 1, dtype=np.int32) * width), pa.py_buffer(raw)])


def _table(column, kind, shape) -> np.ndarray:
    where = np.frombuffer(column.buffers()[1], np.int32)[column.offset :]
    raw = memoryview(column.buffers()[2] or b"")[where[0] : where[len(column)]] if len(column) else b""
    return np.frombuffer(raw, kind).reshape(len(column), PARTS, *shape)


def prepared(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(vec_id, label, parts, near): whole components as 32-bit and distances to the pivots as 64-bit numbers, part after part."""
    size = PARTS * pivots.shape[2]
    same = rows.filter(F.size("embedding") == size)

    @lean
    def run(batches):
        for batch in batches:
            n = batch.num_rows
            column = batch.column("embedding")
            x = whole(column.flatten().to_numpy(zero_copy_only=False)).reshape(n, PARTS, pivots.shape[2])
            near = np.stack([distances(x[:, p], pivots[p]) for p in range(PARTS)], axis=1) if n else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _fixed(x.astype(np.int32), n), _fixed(near, n)], names=["vec_id", "label", "parts", "near"])

    kinds = dict(rows.dtypes)
    return same.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, parts binary, near binary")


def _assigned(batch, books, far):
    """(parts, entries, squared distances) of a batch; the last two a row for each part position."""
    x = _table(batch.column("parts"), np.int32, books.shape[2:]).astype(np.int64)
    near = _table(batch.column("near"), np.float64, far.shape[2:])
    found = [nearest(x[:, p], near[:, p], books[p], far[p])[:2] for p in range(PARTS)]
    return x, np.array([f[0] for f in found]), np.array([f[1] for f in found])


def _to_pivots(books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([distances(b, p) for b, p in zip(books, pivots)])


def next_books(parts: DataFrame, books: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """A round: every entry becomes the floored mean of the parts that are nearest to it; without any it stays."""
    far = _to_pivots(books, pivots)
    places, k, width = books.shape

    @lean
    def run(batches):
        total, count = np.zeros((places * k, width), np.int64), np.zeros(places * k, np.int64)
        for batch in batches:
            x, entry, _ = _assigned(batch, books, far)
            for p in range(places):
                np.add.at(total, entry[p] + p * k, x[:, p])
                count += np.bincount(entry[p] + p * k, minlength=places * k)
        used = np.flatnonzero(count)
        at = np.repeat(used, width)
        place = np.tile(np.arange(width), len(used))
        arrays = [pa.array(v, pa.int64()) for v in (at, place, total[used].ravel(), np.repeat(count[used], width))]
        yield pa.RecordBatch.from_arrays(arrays, names=["entry", "place", "total", "n"])

    sums = parts.select("parts", "near").mapInArrow(run, "entry long, place long, total long, n long")
    out = books.reshape(places * k, width).copy()
    for r in sums.groupBy("entry", "place").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # one for each number of the codebooks
        out[r.entry, r.place] = r.total // r.n
    return out.reshape(books.shape)


def codes(parts: DataFrame, books: np.ndarray, pivots: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every row."""
    far = _to_pivots(books, pivots)

    @lean
    def run(batches):
        for batch in batches:
            _, entry, square = _assigned(batch, books, far)
            text = [bytes(row).hex() for row in entry.T.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), pa.array(text, pa.string()), pa.array(square.sum(0), pa.int64())], names=["vec_id", "label", "code", "error"])

    kinds = dict(parts.dtypes)
    return parts.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def compress(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray | None]:
    """(vec_id, label, code, error) of the rows kept, and the final codebooks (part, entry, component)."""
    rows = kept(embeddings)
    books = first_entries(rows)
    if books is None:  # no id at all
        kinds = dict(embeddings.dtypes)
        return embeddings.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"), None
    pivots = pick_pivots(books)
    with scratch(embeddings.sparkSession):
        parts = cut(prepared(rows, pivots))
        for _ in range(rounds):
            books = next_books(parts, books, pivots)
        return cut(codes(parts, books, pivots), keep=True), books


def label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the errors of all rows with the same label together."""
    sums = cut(coded.groupBy(F.col("label").alias("same_label")).agg(F.sum("error").alias("label_error")))
    few = sums.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    return coded.join(F.broadcast(sums) if few else sums.hint("merge"), F.col("label").eqNullSafe(F.col("same_label"))).drop("same_label")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    listed = "" if books is None else ",".join(map(str, books.ravel().tolist()))
    digest = hashlib.sha256(listed.encode()).hexdigest()
    return label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    distance = "list_sum([(x[i] - e[i]) * (x[i] - e[i]) FOR i IN range(1, len(x) + 1)])"
    nearest_of = lambda r: f"SELECT row, part, any_value(x) AS x, min({{'d': {distance}, 'e': entry}}) AS m FROM parts JOIN books{r} USING (part) GROUP BY row, part"
    steps = []
    for r in range(ROUNDS):
        steps.append(f"near{r} AS MATERIALIZED ({nearest_of(r)})")
        steps.append(
            f"sums{r} AS MATERIALIZED (SELECT part, m.e AS entry, i, sum(x[i])::bigint AS s, count(*) AS n FROM near{r}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) GROUP BY part, m.e, i)"
        )
        steps.append(
            f"books{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(f, e) AS e FROM books{r} LEFT JOIN (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS f FROM sums{r} GROUP BY part, entry) USING (part, entry))"
        )
    return f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, label, embedding FROM embeddings
  WHERE embedding IS NOT NULL AND NOT coalesce(list_bool_or([x IS NULL OR NOT isfinite(x) FOR x IN embedding]), false)),
low AS (SELECT vec_id, min(embedding) AS embedding FROM k WHERE vec_id IS NOT NULL GROUP BY vec_id ORDER BY vec_id LIMIT {ENTRIES}),
parts AS MATERIALIZED (
  SELECT row, part, [floor({SCALE} * x::double)::bigint FOR x IN embedding[part * len(embedding) // {PARTS} + 1:(part + 1) * len(embedding) // {PARTS}]] AS x
  FROM k, (SELECT unnest(range(0, {PARTS})) AS part)),
books0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry,
    [floor({SCALE} * x::double)::bigint FOR x IN embedding[part * len(embedding) // {PARTS} + 1:(part + 1) * len(embedding) // {PARTS}]] AS e
  FROM low, (SELECT unnest(range(0, {PARTS})) AS part)),
{", ".join(steps)},
last AS MATERIALIZED ({nearest_of(ROUNDS)}),
coded AS (SELECT row, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::bigint AS error FROM last GROUP BY row)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::bigint AS label_error,
  (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM books{ROUNDS}) AS codebooks_sha256
FROM coded JOIN k USING (row)
"""


ORACLE = _oracle()
