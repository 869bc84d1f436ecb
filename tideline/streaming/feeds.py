"""Structured Streaming over landed files: resumable upserts, watermarked half-hours, gap detection with state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..operators.tables import exists, shared
from ..operators.upsert import upsert


def file_stream(spark: SparkSession, directory: str, name: str, schema, files: int | None = None) -> DataFrame:
    """New files of one name in a directory, as a stream; at most `files` of them in a micro-batch, the oldest first."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}*")
    return (reader if files is None else reader.option("maxFilesPerTrigger", files)).parquet(directory)


def state_session(spark: SparkSession) -> SparkSession:
    """A session for streams whose state RocksDB holds, beside executors' memory; other sessions keep their settings."""
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    own.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    return own


def run_once(df: DataFrame, path: str, writer) -> None:
    """Process everything that has arrived and stop; the checkpoint lets the next run go on from there."""
    query = df.writeStream.foreachBatch(writer).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()


def upsert_stream(df: DataFrame, table: str, path: str, keys: Sequence[str], ts: str, metadata: Sequence[str] = (), arrival: str | None = None) -> None:
    """Arriving rows and corrections of earlier ones merged into a table; a batch that is replayed changes nothing."""
    run_once(df, path, lambda batch, _: upsert(batch.sparkSession, table, batch, keys, ts, metadata, arrival))


def _bound(spark: SparkSession, path: str, number: int, batch: DataFrame, ts: str, days: int):
    """The time before which rows of this micro-batch are late: `days` before the newest row of all batches before it.

    Kept by batch number before anything is merged, so a batch that is replayed is routed as it was the first time.
    """
    place = f"{path}/bounds/batch={number}"
    if not exists(spark, f"{place}/_SUCCESS"):
        seen = batch.agg(F.max(ts).cast("timestamp_ntz").alias("newest"))
        if number and exists(spark, f"{path}/bounds/batch={number - 1}/_SUCCESS"):
            before = spark.read.parquet(f"{path}/bounds/batch={number - 1}")
            seen = before.select((F.col("newest") - F.expr(f"INTERVAL {days} DAYS")).alias("bound"), F.col("newest").alias("last")).crossJoin(seen)
            seen = seen.select("bound", F.greatest("last", "newest").alias("newest"))
        else:
            seen = seen.select(F.lit(None).cast("timestamp_ntz").alias("bound"), "newest")
        seen.write.mode("overwrite").parquet(place)
    return spark.read.parquet(place).first().bound


def bounded_upsert_stream(df: DataFrame, path: str, keys: Sequence[str], ts: str, refetch_days: int, metadata: Sequence[str] = (), arrival: str | None = None) -> None:
    """As upsert_stream, into path/table, but for rows older than the days that a run fetches again: these go to path/late.

    A late row stands there once, however often it arrives: rows alike in all but metadata and arrival are one. The bound moves
    with the newest row of earlier micro-batches and is kept with them. A row without a time is refused, as one without a key.
    """

    def write(batch, number):
        spark = batch.sparkSession
        bound = _bound(spark, path, number, batch, ts, refetch_days)
        late = F.lit(False) if bound is None else F.col(ts) < F.lit(bound)
        upsert(spark, f"{path}/table", batch.filter(~F.coalesce(late, F.lit(False))), keys, ts, metadata, arrival)
        if bound is not None:
            values = [c for c in batch.columns if c != arrival and c not in metadata]
            same = F.sha2(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}), 256)
            upsert(spark, f"{path}/late", batch.filter(late).withColumn("late_key", same), ["late_key"], ts, [*metadata, *([arrival] if arrival else [])], None)

    run_once(df, path, write)


def incremental_run(spark: SparkSession, sources: dict[str, tuple], path: str) -> DataFrame:
    """Every source read on from where its last run ended; (dataset, inserted, updated, unchanged, problem), a row for each.

    sources: name -> (stream, keys, time column, arrival column). Tables and checkpoints stand under path by name. A source that
    fails has its problem in its row, and the others go on.
    """
    report = []
    for name, (stream, keys, ts, arrival) in sources.items():
        seen = [0, 0, 0]

        def write(batch, _, name=name, keys=keys, ts=ts, arrival=arrival, seen=seen):
            done = upsert(batch.sparkSession, f"{path}/{name}/table", batch, keys, ts, (), arrival)
            for k, n in enumerate(("inserted", "updated", "unchanged")):
                seen[k] += done[n]

        try:
            run_once(stream, f"{path}/{name}", write)
            report.append((name, *seen, None))
        except Exception as error:  # noqa: BLE001  (stands in the report)
            report.append((name, *seen, f"{type(error).__name__}: {error}"[:200]))
    return spark.createDataFrame(report, "dataset string, inserted long, updated long, unchanged long, problem string")


def half_hourly(df: DataFrame, ts: str, lateness: str = "2 days") -> DataFrame:
    """Counts and sums per half-hour, final once the watermark has passed. The time column becomes a TIMESTAMP here."""
    at = df.withColumn("at", F.col(ts).cast("timestamp")).withWatermark("at", lateness)
    return at.groupBy(F.window("at", "30 minutes")).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).select(F.col("window.start").cast("timestamp_ntz").alias("ts"), "n", "cents")


def collect_append(df: DataFrame, schema: str) -> DataFrame:
    """Run an append-mode stream to its end and read what it wrote."""
    spark, path = df.sparkSession, shared(df.sparkSession)
    df.writeStream.format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(schema).parquet(f"{path}/out")


def _outages(key, frames, state: GroupState):
    """Holes between a key's consecutive half-hours; the last one seen is the state."""
    last = state.get[0] if state.exists else None
    times = sorted({t for f in frames for t in f["epoch"].tolist()})
    out = []
    for t in times:
        if last is not None and t > last + 1800:
            out.append((key[0], last + 1800, t))
        last = t if last is None else max(last, t)
    if last is not None:
        state.update((last,))
    yield pd.DataFrame(out, columns=["key", "start_s", "end_s"])


NO_END = -1
SILENCE = 86_400  # seconds without a row after which a key counts as silent
BUCKETS = 1024  # what keys are dealt to; a stream keeps to the number it began with


class Outages(StatefulProcessor):
    """Holes in a key's half-hours, told once no row can fill them any more, and keys that have fallen silent.

    The state is what is undecided: runs of half-hours seen since the last final hole, so late rows shrink, split or close an open
    hole, and a key's memory grows with its open holes, not with its rows. The keys of a bucket are held in one value and settled
    together: a bucket costs a few calls of the state store, whatever keys and runs it has. One timer stands for a bucket, at the
    first time at which an open hole of its keys ends or a silence gets too long.
    """

    def __init__(self, silence: int = SILENCE):
        self.silence = silence

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # runs in the order of key and begin, as whole numbers of eight bytes; told: whether a silence from the run's end on was told
        self.held = handle.getValueState("held", "keys binary, begins binary, ends binary, told binary, timer_s long")

    def handleInputRows(self, key, rows, timerValues):
        keys, begins, ends, told, timer = self._held()
        known, at = np.unique(keys, return_index=True)
        first = begins[at]
        for frame in rows:
            k, t = frame["key"].to_numpy(dtype="int64"), frame["epoch"].to_numpy(dtype="int64")
            if len(known):
                at = np.minimum(np.searchsorted(known, k), len(known) - 1)
                live = (known[at] != k) | (t >= first[at])  # what lies before is final
                k, t = k[live], t[live]
            keys, begins, ends, told = _merged_by_key(np.concatenate([keys, k]), np.concatenate([begins, t]), np.concatenate([ends, t + 1800]), np.concatenate([told, np.zeros(len(k), bool)]))
        yield from self._settle(keys, begins, ends, told, timer, timerValues.getCurrentWatermarkInMs() // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        keys, begins, ends, told, _ = self._held()  # the timer goes by itself
        yield from self._settle(keys, begins, ends, told, None, timerValues.getCurrentWatermarkInMs() // 1000)

    def _held(self):
        found = self.held.get() or (b"", b"", b"", b"", None)
        return *(np.frombuffer(x, np.int64) for x in found[:3]), np.frombuffer(found[3], bool), found[4]

    def _settle(self, keys, begins, ends, told, timer: int | None, now: int) -> Iterator[pd.DataFrame]:
        """Tell of holes that end by now, keep what is after them."""
        final = np.zeros(len(keys), bool)
        final[:-1] = (keys[1:] == keys[:-1]) & (begins[1:] <= now)
        at = np.flatnonzero(final)
        holes = pd.DataFrame({"key": keys[at], "kind": "hole", "start_s": ends[at], "end_s": begins[at + 1]})
        keys, begins, ends, told = (x[~final] for x in (keys, begins, ends, told))
        last = np.ones(len(keys), bool)
        last[:-1] = keys[1:] != keys[:-1]
        silent = last & ~told & (now >= ends + self.silence)
        quiet = pd.DataFrame({"key": keys[silent], "kind": "silent", "start_s": ends[silent], "end_s": NO_END})
        told = told | silent
        awaited = np.concatenate([begins[1:][~last[:-1]], ends[last & ~told] + self.silence])
        wanted = int(awaited.min()) if len(awaited) else None
        if wanted != timer:
            if timer is not None:
                self.handle.deleteTimer(timer * 1000)
            if wanted is not None:
                self.handle.registerTimer(wanted * 1000)
        self.held.update((keys.tobytes(), begins.tobytes(), ends.tobytes(), told.tobytes(), wanted))
        if len(holes) or len(quiet):
            yield pd.concat([holes, quiet], ignore_index=True)

    def close(self) -> None:
        pass


def _merged(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals that touch or overlap as one."""
    order = np.argsort(begins, kind="stable")
    begins, reach = begins[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return begins[at], reach[np.append(at[1:] - 1, len(begins) - 1)] if len(begins) else ends


def _merged_by_key(keys: np.ndarray, begins: np.ndarray, ends: np.ndarray, told: np.ndarray) -> tuple[np.ndarray, ...]:
    """_merged for each key, in the order of keys; a run is told of if one with its end was."""
    if not len(keys):
        return keys, begins, ends, told
    names, at = np.unique(keys, return_inverse=True)
    low = begins.min()
    width = ends.max() - low + 2  # so that runs of different keys don't touch
    b, e = begins - low + at * width, ends - low + at * width
    marked = e[told]
    b, e = _merged(b, e)
    at = b // width
    return names[at], b - at * width + low, e - at * width + low, np.isin(e, marked)


def final_outages(df: DataFrame, key: str, ts: str, lateness: str = "2 days", silence: int = SILENCE, buckets: int = BUCKETS) -> DataFrame:
    """(key, kind, start_ts, end_ts): "hole" where half-hours are missing for good, "silent" (no end) where a key has stopped.

    The stream's session needs RocksDB for its state (state_session). Rows without a key or time are left out. Some thousand keys
    a bucket are well; each micro-batch reads and writes the open runs of the buckets that it has rows of.
    """
    at = F.col(ts).cast("timestamp")
    rows = df.select(F.col(key).cast("long").alias("key"), at.alias("at"), (F.floor(F.unix_timestamp(at) / 1800) * 1800).alias("epoch")).filter("key is not null and at is not null")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    schema = "key long, kind string, start_s long, end_s long"
    found = rows.withWatermark("at", lateness).groupBy("bucket").transformWithStateInPandas(Outages(silence), schema, "Append", "EventTime")
    as_ntz = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return found.select("key", "kind", as_ntz("start_s").alias("start_ts"), as_ntz(F.nullif("end_s", F.lit(NO_END))).alias("end_ts"))


def outages(df: DataFrame, key: str, ts: str) -> DataFrame:
    """(key, start_ts, end_ts) of each hole in a key's half-hours, across micro-batches. Late rows don't reopen a closed hole."""
    rows = df.select(F.col(key).cast("long").alias("key"), (F.floor(F.unix_timestamp(F.col(ts)) / 1800) * 1800).alias("epoch"))
    found = rows.groupBy("key").applyInPandasWithState(_outages, "key long, start_s long, end_s long", "last long", "append", GroupStateTimeout.NoTimeout)
    as_ntz = lambda c: F.timestamp_seconds(c).cast("timestamp_ntz")
    return found.select("key", as_ntz("start_s").alias("start_ts"), as_ntz("end_s").alias("end_ts"))
