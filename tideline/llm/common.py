"""What several corpus operators share: checkpoints, row keys, vectorised hashing of bytes."""

from __future__ import annotations

import functools
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text contracts, as a Java and DuckDB character class.
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; local sessions may go without the setting (tests)."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="tideline-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(place)
    return place


_scratch: list[list[str]] = []  # what the scratch blocks that are open have written, the innermost last


def cut(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write a result to the shared folder and go on from the written rows: the lineage ends here.

    Inside a scratch block the rows go with it, but for those to keep.
    """
    place = f"{shared_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    held = _scratch[:-1] if keep else _scratch
    if held:
        held[-1].append(place)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


@contextmanager
def scratch(spark: SparkSession):
    """What is cut inside is removed at the end."""
    _scratch.append([])
    try:
        yield
    finally:
        for place in _scratch.pop():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def records_per_batch(spark: SparkSession, most: int):
    """Actions inside send Python workers at most so many rows at once."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def body(text: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells rows of one doc_id with different texts apart; rows equal in both share it."""
    return F.xxhash64(F.col(doc_id), body(text))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def smallest_hashes(rows: DataFrame, limit: int, *salt: str) -> DataFrame:
    """Of the distinct values of a one-column table, the `limit` with the smallest hashes: the same at every run.

    Values whose hash is far too large to be among them leave before the sort, so that what one task merges is bounded.
    """
    name = rows.columns[0]
    place = F.xxhash64(name, *(F.lit(s) for s in salt))
    many = rows.agg(F.approx_count_distinct(name)).first()[0]
    if many > 8 * limit:
        rows = rows.filter(place <= F.lit((1 << 64) * 4 * limit // many - (1 << 63)))
    return rows.distinct().orderBy(place).limit(limit)


SLOTS = 1 << 18  # words of 64 bits in a table of marks: 2 MB for any number of rows


def marks(rows: DataFrame, *names: str, keep: bool = False) -> DataFrame:
    """One row, whose array `words` has a bit set for the columns `names` of each row: what `marked` looks rows up in."""
    h = F.xxhash64(*names)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))
    found = rows.select(h.bitwiseAND(F.lit(SLOTS - 1)).alias("slot"), bit.alias("word"))
    every = rows.sparkSession.range(0, SLOTS, 1, 1).select(F.col("id").alias("slot"), F.lit(0).cast("long").alias("word"))
    words = found.unionByName(every).groupBy("slot").agg(F.bit_or("word").alias("word"))
    return cut(words.agg(F.sort_array(F.collect_list(F.struct("slot", "word")))["word"].alias("words")), keep)


def marked(table: DataFrame, *columns: str | Column) -> Column:
    """False only where the values are in none of the rows that `table` marks.

    A few others are true as well (n rows of n / 2**24), so an exact join has to follow; the rows that are false needn't be moved to it.
    """
    h = F.xxhash64(*columns)
    word = F.get(table.scalar(), h.bitwiseAND(F.lit(SLOTS - 1)).cast("int"))
    return F.call_function("shiftright", word, F.shiftrightunsigned(h, 58).cast("int")).bitwiseAND(F.lit(1)) == 1


def lean(run):
    """For functions over Arrow batches: at a task's end its worker, which is kept, gives free memory back to the system."""

    @functools.wraps(run)
    def whole(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return whole


# ---- hashing of byte and word sequences: polynomials modulo 2**64, by prefix sums ----

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse, for i < n; kept for later calls of the same worker."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            _powers[0] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, _BASE)]))
            inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
            _powers[1] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, inverse)]))
    return _powers[0][:n], _powers[1][:n]


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def prefixes(codes: np.ndarray) -> np.ndarray:
    """P with P[j] - P[i] the polynomial of codes[i:j], shifted by i."""
    up, _ = powers(len(codes))
    out = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * up, out=out[1:])
    return out


def spans_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The hash of codes[start:end], the same wherever the codes stand."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def anchors(prefix: np.ndarray, n: int, gram: int, reach: int) -> np.ndarray:
    """For each of the n - gram - reach + 2 runs of `reach` grams among n codes, the place of its smallest gram hash.

    Of grams whose hashes agree in 32 bits the first is taken, so equal codes have their anchors at equal places everywhere.
    """
    at = np.arange(n - gram + 1, dtype=np.uint64)
    low = (spans_hash(prefix, at.astype(np.int64), at.astype(np.int64) + gram) >> np.uint64(32) << np.uint64(32)) | at
    size = 1
    while 2 * size <= reach:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < reach:
        low = np.minimum(low[: len(low) - (reach - size)], low[reach - size :])
    return (low & np.uint64(0xFFFFFFFF)).astype(np.int64)


def blocks_of(offsets: np.ndarray, limit: int):
    """Runs (i, j) of consecutive rows with about `limit` bytes together, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """An Arrow string or binary column as one byte array and its row offsets (nulls are empty)."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]
