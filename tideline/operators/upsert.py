"""Idempotent keyed upserts into tables of months with snapshots, file manifests and change-detected refreshes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import versions
from .tables import exists, remove, written


def conform(df: DataFrame, schema) -> DataFrame:
    """The schema's columns, no more and no less, cast strictly."""
    names = [f.name for f in schema.fields]
    if set(df.columns) != set(names):
        raise ValueError(f"columns differ: missing {sorted(set(names) - set(df.columns))}, extra {sorted(set(df.columns) - set(names))}")
    return df.select(*(F.col(f.name).cast(f.dataType) for f in schema.fields))


def classify(old: DataFrame, batch: DataFrame, keys: Sequence[str], metadata: Sequence[str] = (), arrival: str | None = None) -> DataFrame:
    """The batch's last row per key with change: insert, update or same (metadata columns don't count).

    Keys are compared by plain equality: upsert() refuses null keys.
    """
    if arrival:
        rest = [c for c in batch.columns if c not in keys]
        batch = batch.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(arrival)).alias("_r")).select(*keys, "_r.*").drop(arrival)
    values = [c for c in batch.columns if c not in keys and c not in metadata]
    before = old.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in values), F.lit(True).alias("_had"))
    joined = batch.join(before, list(keys), "left")
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in values), F.lit(False))
    change = F.when(F.col("_had").isNull(), "insert").when(differs, "update").otherwise("same")
    return joined.withColumn("change", change).select(*batch.columns, "change")


def upsert_stats(classified: DataFrame) -> DataFrame:
    """(inserted, updated, unchanged) in one pass; statistics of several batches add up."""
    count = [F.sum((F.col("change") == k).cast("long")).alias(n) for k, n in (("insert", "inserted"), ("update", "updated"), ("same", "unchanged"))]
    return classified.agg(*(F.coalesce(c, F.lit(0)).alias(n) for c, n in zip(count, ("inserted", "updated", "unchanged"))))


def rows_of(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """The rows of a table's newest version, typed but empty where there is none yet (a schema is needed then)."""
    found = versions.read(spark, path, schema)
    return spark.createDataFrame([], schema) if found is None else found


def upsert(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], ts: str, metadata: Sequence[str] = (), arrival: str | None = None) -> dict:
    """Merge a batch into the table at path; only months with an insert or update are rewritten, and become current all at once.

    The batch is evaluated once: written aside with its changes. Readers see the version before until the new one is committed; a
    second writer that began from the same version is refused (versions.ConcurrentWrite), and may merge its batch again.
    """
    base = versions.newest(spark, path)
    staged = f"{path}/{versions.stage(path)}"
    try:
        landed = written(batch.withColumn("_ym", F.date_format(ts, "yyyy-MM")), f"{staged}/batch")
        nulls = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
        if not landed.filter(nulls).isEmpty():
            raise ValueError("null in a key column")
        of_batch = [r[0] for r in landed.select("_ym").distinct().collect()]  # as many as months in the batch
        landed = landed.drop("_ym")
        columns = [c for c in batch.columns if c != arrival]
        old = versions.read(spark, path, landed.select(columns).schema, base, of_batch)
        old = spark.createDataFrame([], landed.select(columns).schema) if old is None else old
        flags = written(classify(old, landed, keys, metadata, arrival), f"{staged}/flags")
        stats = upsert_stats(flags).first().asDict()
        changed = flags.filter("change <> 'same'")
        touched = sorted(r[0] for r in changed.select(F.date_format(ts, "yyyy-MM")).distinct().collect())
        if touched:
            kept = old.filter(F.date_format(ts, "yyyy-MM").isin(touched)).join(changed.select(*keys), list(keys), "left_anti")
            versions.commit(spark, path, base, versions.write_months(kept.unionByName(changed.drop("change")), path, ts))
        return stats | {"months": touched}
    finally:
        remove(spark, staged)


PIECE, WHOLE = 8 << 20, 64 << 20  # bytes that are hashed at once; files beyond WHOLE are read piece by piece


def _stream_digests(batches):
    """Files read as streams by the task that they are dealt to, in constant memory."""
    import hashlib

    import pyarrow as pa
    from pyarrow import fs

    for batch in batches:
        sums = []
        for path in batch.column("path").to_pylist():
            store, place = fs.FileSystem.from_uri(path)
            digest = hashlib.sha256()
            with store.open_input_stream(place) as stream:
                while piece := stream.read(PIECE):
                    digest.update(piece)
            sums.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("bytes"), pa.array(sums, pa.string())], names=["path", "bytes", "sha256"])


def file_manifest(spark: SparkSession, path: str, rows: bool = False, whole: int = WHOLE) -> DataFrame:
    """(path, bytes, sha256) of every file under path that has bytes, with the rows of Parquet files on request.

    Files of up to `whole` bytes are read by Spark as one value each; larger ones never stand in a row: their paths are dealt to
    tasks, which read them as streams (the store has to be one that Arrow opens: local, HDFS, S3, GCS).
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(path)
    small = found.filter(F.col("length") <= whole).select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    large = found.select("path", F.col("length").alias("bytes")).filter(F.col("bytes") > whole).repartition("path")
    out = small.unionByName(large.mapInArrow(_stream_digests, "path string, bytes long, sha256 string"))
    if not rows:
        return out
    counts = spark.read.option("recursiveFileLookup", "true").parquet(path).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return out.join(counts, "path", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def publish(rows: DataFrame, place: str) -> int:
    """Rows as files with a manifest beside them, which is written last; nothing at all where there are no rows. The number of rows."""
    spark = rows.sparkSession
    if rows.isEmpty():
        return 0
    rows.write.parquet(f"{place}/files")
    file_manifest(spark, f"{place}/files", rows=True).coalesce(1).write.json(f"{place}/manifest")
    return spark.read.parquet(f"{place}/files").count()


def restore_published(spark: SparkSession, place: str, table: str, keys: Sequence[str], ts: str, metadata: Sequence[str] = ()) -> dict:
    """What publish() has left at a place, merged into a table; {"status": "no-mirror"} where nothing has been published yet."""
    if not exists(spark, f"{place}/manifest"):
        return {"status": "no-mirror"}
    manifest = spark.read.schema("path string, bytes long, sha256 string, rows long").json(f"{place}/manifest")
    return {"status": "restored", **restore(spark, manifest, f"{place}/files", table, keys, ts, metadata)}


def restore(spark: SparkSession, manifest: DataFrame, published: str, table: str, keys: Sequence[str], ts: str, metadata: Sequence[str] = ()) -> dict:
    """Published Parquet files merged into a table, after each was found as its manifest row (path, sha256, rows) has it.

    A missing or changed file, a wrong count or a manifest without rows is an error, before anything is written.
    """
    if manifest.isEmpty():
        raise ValueError("the manifest lists no files")
    found = file_manifest(spark, published)
    bad = [r.path for r in corrupt_files(manifest, found).select("path").limit(20).collect()]
    if bad:
        raise ValueError(f"files that differ from the manifest: {bad}")
    listed = spark.read.option("recursiveFileLookup", "true").parquet(published).withColumn("_path", F.col("_metadata.file_path"))
    counted = listed.groupBy(F.col("_path").alias("path")).agg(F.count(F.lit(1)).alias("found"))
    wrong = manifest.select("path", "rows").join(counted, "path", "left").filter(F.col("rows") != F.coalesce("found", F.lit(0)))
    if not wrong.isEmpty():
        raise ValueError("row counts differ from the manifest")
    rows = listed.join(manifest.select(F.col("path").alias("_path")), "_path", "left_semi").drop("_path")
    return upsert(spark, table, rows, keys, ts, metadata)


#: Conditions of Spark that tell of a file's content: values and records that can't be read as their types.
BAD = ("CAST_INVALID_INPUT", "CAST_OVERFLOW", "MALFORMED_RECORD", "MALFORMED_CSV_RECORD", "CANNOT_PARSE_TIMESTAMP", "UNRESOLVED_COLUMN", "FAILED_READ_FILE", "USER_RAISED_EXCEPTION")


def _bad_content(error: Exception) -> bool:
    """Whether a reader found fault with the file, by its own ValueError or by a condition of Spark's, at any depth of the causes."""
    if isinstance(error, ValueError):
        return True
    return isinstance(error, PySparkException) and any(name in f"{error.getCondition()} {error}" for name in BAD)


def refresh(spark: SparkSession, landed: str, table: str, read) -> str:
    """A table that one landed file replaces whole: "unchanged", "replaced", or "kept" where the new file is bad.

    read(path) -> rows, and raises BAD on a bad file, as do the rows when they are read; anything else that fails, such as a lost
    executor or a full disk, is an error here too. A version is written beside the old ones under its content's hash and
    becomes the current one by a row in `versions`, so readers never see a part of it; see current().
    """
    found = [r.sha256 for r in file_manifest(spark, landed).select("sha256").limit(2).collect()]
    if len(found) != 1:
        raise ValueError(f"{landed} should be one file")
    version = found[0]
    last = _last_version(spark, table)
    if version == last:
        return "unchanged"
    try:
        rows = read(landed)
        rows.write.mode("overwrite").parquet(f"{table}/data-{version}")
    except Exception as error:
        if last is None or not _bad_content(error):
            raise
        return "kept"
    spark.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("since")).write.mode("append").parquet(f"{table}/versions")
    return "replaced"


def _last_version(spark: SparkSession, table: str) -> str | None:
    if not exists(spark, f"{table}/versions"):
        return None
    return spark.read.parquet(f"{table}/versions").agg(F.max_by("version", "since")).first()[0]


def current(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a refreshed table's current version."""
    return spark.read.parquet(f"{table}/data-{_last_version(spark, table)}")


def corrupt_files(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Manifest rows whose file is missing or has another hash."""
    now = found.select("path", F.col("sha256").alias("found"))
    return manifest.join(now, "path", "left").filter(~F.col("sha256").eqNullSafe(F.col("found")))


def changed_files(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Landed files that the manifest doesn't have with this hash: the ones a refresh has to read."""
    return found.join(manifest.select("path", "sha256"), ["path", "sha256"], "left_anti")
