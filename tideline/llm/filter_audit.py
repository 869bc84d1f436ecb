"""Filter interaction audit: what each filter removes, and has left to remove, under every order of five filters.

The documents' files are read as a stream in available-now micro-batches. A row becomes a mask of the filters that it fails;
four of them are known from its text alone, the fifth (a copy of a text with a smaller doc_id) depends on all other rows. So the
stream keeps a state by text: the smallest doc_id seen, and which rows have it. When a smaller id arrives, the earlier
row's mask is retracted from the counter of its part and counted again as a copy's. The sink holds changes of counters only;
their sum after the last batch is the same whatever the order in which files arrive.

From the counters (part, mask, labels) every order, step and share follows: a row that fails k filters is removed by each of
them in 120 / k orders.

Spread and bounds: states lie in buckets of about BUCKET texts, by the text's SHA-256, so that a worker is called once a
bucket and batch and reads its states as columns; they are held by RocksDB, not in memory. Rows of one text are added up
within each Arrow batch before they are shuffled, so a text that a third of all rows share reaches its state as a row a batch.
Texts never leave the task that reads them. A restarted task finds its state and input by the stream's checkpoint.

Defined results: null text is empty (it fails A only, unless it is a copy); null lang is the part ''; a row with a null
doc_id is no copy, and makes none; rows with one doc_id and one text are no copies of each other; several labels of a doc_id count as
1 if any is; an empty table gives an empty result; columns beyond doc_id, text and lang are not read, whatever their names.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, body, lean, read_documents, shared_dir

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
BATCHES = 8  # micro-batches that the files are dealt to; each rewrites the states that it touches, 60 bytes a text
BUCKET = 1024  # texts that share a state row, about

_GROUP = ["part", "mask", "good", "toxic"]
_STATE = "part string, mask int, good int, toxic int"


def masks() -> Column:
    """Bits of the filters A to D that a text with its words fails."""
    text, words = F.col("text"), F.col("words")
    count, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    fails = (count < 100, 100 * distinct < 80 * count, 100 * capitals > 10 * F.length(text), text.rlike("[#$%&*|]"))
    return sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails)), F.lit(0))


def masked(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """A narrow row a document, with its labels; docs may be a stream. Null ids are salted, so that they don't meet in one task."""
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), body().alias("text"))
    rows = rows.select("*", words.alias("words"), F.unhex(F.sha2("text", 256)).alias("digest")).select("doc_id", "part", "digest", masks().alias("mask"))
    rows = rows.withColumn("salt", F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0))
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    flag = lambda name: F.max(F.when(F.col(name) == 1, 1).otherwise(0)).alias(name)
    known = known.agg(flag("quality"), flag("toxic")).withColumn("salt", F.lit(0).cast("long"))
    good, toxic = (F.coalesce(F.col(c), F.lit(0)).alias(n) for c, n in (("quality", "good"), ("toxic", "toxic")))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket")
    return rows.join(known, ["doc_id", "salt"], "left").select(bucket, "digest", "doc_id", "part", "mask", good, toxic)


def added_up(df: pd.DataFrame) -> pd.DataFrame:
    """Rows of one text, part and labels as one: their number, smallest id, and how many have it (null ids apart)."""
    keys = ["bucket", "digest", "free", *_GROUP]
    df["low"] = df.groupby(keys, sort=False)["doc_id"].transform("min")
    df["at_low"] = (df["doc_id"] == df["low"]).astype("int64")
    return df.groupby(keys, sort=False, as_index=False).agg(low=("low", "min"), at_low=("at_low", "sum"), n=("low", "size"))


@lean
def _combine(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("doc_id")
        df = pa.table([batch.column(c) for c in ("bucket", "digest", *_GROUP)], names=["bucket", "digest", *_GROUP]).to_pandas()
        df["doc_id"], df["free"] = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        yield pa.RecordBatch.from_pandas(added_up(df), preserve_index=False)


def _packed(df: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_pandas(df, preserve_index=False)
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def step(known: pd.DataFrame | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """States (digest, group, low, n: rows that have the smallest id) and arriving rows -> new states, changes of counters."""
    free, rows = rows[rows["free"]], rows[~rows["free"]]
    changes = [free[[*_GROUP, "n"]], rows[[*_GROUP, "n"]].assign(mask=rows["mask"] | COPY)]  # copies, until they prove to be first
    columns = ["digest", *_GROUP, "low", "n"]
    seen = rows[["digest", *_GROUP, "low", "at_low"]].rename(columns={"at_low": "n"}).assign(new=True)
    every = seen if known is None else pd.concat([known.assign(new=False), seen], ignore_index=True)
    first = every["low"] == every.groupby("digest", sort=False)["low"].transform("min")

    def moved(which, sign):
        plain = every.loc[which, [*_GROUP, "n"]]
        return [plain.assign(n=sign * plain["n"]), plain.assign(mask=plain["mask"] | COPY, n=-sign * plain["n"])]

    changes += moved(first & every["new"], 1)
    changes += moved(~first & ~every["new"], -1)  # retracted
    held = every[first].groupby(columns[:-1], sort=False, as_index=False)["n"].sum()
    total = pd.concat(changes, ignore_index=True).groupby(_GROUP, sort=False, as_index=False)["n"].sum()
    return held[columns], total[total["n"] != 0]


def _advance(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """One bucket's rows of a micro-batch, as bounded frames, go through its states."""
    known = pa.ipc.open_stream(state.get[0]).read_all().to_pandas() if state.exists else None
    for rows in frames:
        if len(rows):
            known, changes = step(known, rows)
            if len(changes):
                yield changes.astype({"mask": "int32", "good": "int32", "toxic": "int32", "n": "int64"})
    if known is not None:
        state.update((_packed(known),))


def counters(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """(part, mask, good, toxic, n) of a stream of documents that is read to its end."""
    spark = docs.sparkSession
    place = f"{shared_dir(spark)}/audit-{uuid.uuid4().hex}"
    added = "bucket long, digest binary, free boolean, part string, mask int, good int, toxic int, low long, at_low long, n long"
    rows = masked(docs, labels, buckets).mapInArrow(_combine, added)
    changes = rows.groupBy("bucket").applyInPandasWithState(_advance, f"{_STATE}, n long", "states binary", "append", "NoTimeout")
    sink = changes.writeStream.format("parquet").option("path", f"{place}/changes").option("checkpointLocation", f"{place}/checkpoint")
    sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    found = spark.read.schema(f"{_STATE}, n long").parquet(f"{place}/changes")
    return found.groupBy(*_GROUP).agg(F.sum("n").alias("n")).filter("n <> 0")


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it) of all orders."""
    out = []
    for order in map("".join, itertools.permutations(FILTERS)):
        bits = [1 << FILTERS.index(f) for f in order]
        out += [(order, i + 1, b, sum(bits[:i])) for i, b in enumerate(bits)]
    return out


def report(counts: DataFrame) -> DataFrame:
    """A row for each part, order and step, from the counters; 600 times as many rows as there are counters, added up in their tasks."""
    spark = counts.sparkSession
    by_mask = counts.groupBy("part", "mask").agg(*(F.sum(F.when(F.lit(c) if c is True else F.col(c) == 1, F.col("n")).otherwise(0)).alias(a) for c, a in ((True, "n"), ("good", "good"), ("toxic", "toxic"))))
    orders = spark.createDataFrame(_steps(), "filter_order string, step int, bit int, before int").agg(F.collect_list(F.struct("filter_order", "step", "bit", "before")).alias("steps"))
    rows = by_mask.join(F.broadcast(orders)).select("*", F.inline("steps")).drop("steps")  # one row of 600 steps
    mask, bit, before = F.col("mask"), F.col("bit"), F.col("before")
    fails, earlier = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    turns = (F.lit(math.factorial(len(FILTERS))) / F.bit_count(mask)).cast("long")  # orders in which a failing filter comes first
    total = lambda when, value="n": F.sum(F.when(when, F.col(value) if isinstance(value, str) else value).otherwise(0)).cast("long")
    return rows.groupBy("part", "filter_order", "step").agg(
        total(~earlier & ~fails).alias("kept"),
        total(~earlier & fails).alias("removed"),
        total(earlier & fails).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(~earlier & fails, "good").alias("good_lost"),
        total(~earlier & fails, "toxic").alias("toxic_lost"),
        total(fails, F.col("n") * turns).alias("shapley"),
    )


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    files, rows = len(docs.inputFiles()), docs.count()
    other = spark.newSession()  # the stream's settings are its own
    other.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    other.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    other.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    other.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")  # many small stores: no space ahead of its use
    if not rows:
        return report(spark.createDataFrame([], f"{_STATE}, n long"))
    stream = other.readStream.schema(docs.schema).option("maxFilesPerTrigger", -(-files // BATCHES)).parquet(f"{sf_dir}/{{documents}}.parquet")  # a pattern may name a single file
    counts = counters(stream, other.read.parquet(f"{sf_dir}/labels.parquet"), -(-rows // BUCKET))
    return report(counts)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
flags AS (SELECT doc_id, max((quality = 1)::int) AS good, max((toxic = 1)::int) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > low, false)] AS f
  FROM d JOIN firsts USING (t) LEFT JOIN flags ON flags.doc_id = d.doc_id),
c AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic, len([x FOR x IN f IF x]) AS k FROM m GROUP BY part, f),
one AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM one a, one b, one c, one d, one e WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
steps AS (SELECT filter_order, s AS step, [strpos('ABCDE', x) FOR x IN string_split(filter_order, '')] AS places FROM orders, (SELECT unnest(range(1, 6)) AS s)),
r AS (
  SELECT part, filter_order, step, n, good, toxic, k, f[places[step]] AS fails, coalesce(list_bool_or([f[p] FOR p IN places[1:step - 1]]), false) AS earlier
  FROM c, steps)
SELECT part, filter_order, step::int AS step,
  coalesce(sum(n) FILTER (NOT fails AND NOT earlier), 0)::bigint AS kept,
  coalesce(sum(n) FILTER (fails AND NOT earlier), 0)::bigint AS removed,
  coalesce(sum(n) FILTER (fails AND earlier), 0)::bigint AS redundant,
  coalesce(sum(n) FILTER (fails AND k = 1), 0)::bigint AS unique_fails,
  coalesce(sum(good) FILTER (fails AND NOT earlier), 0)::bigint AS good_lost,
  coalesce(sum(toxic) FILTER (fails AND NOT earlier), 0)::bigint AS toxic_lost,
  coalesce(sum(n * 120 // greatest(k, 1)) FILTER (fails), 0)::bigint AS shapley
FROM r GROUP BY part, filter_order, step
"""
