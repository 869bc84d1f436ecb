"""Exact deduplication against a persistent digest index.

The index is a Parquet table, bucketed and sorted by digest. A batch is reduced to one candidate per digest, the
candidates that the index lacks are found by a sort-merge anti-join (both sides bucketed alike, so the index itself is
never shuffled) and appended. Only DataFrame functions are used.

Defined results: a null text counts as empty; white-space runs count as one space; of equal texts the smallest doc_id
stays, a null doc_id only if the group has no other; a row repeated with the same doc_id stays once; columns beyond doc_id and text are carried along, whatever their names; an empty
batch appends nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, body, cut, partitions, read_documents, scratch

#: A digest that holds this share of a batch is hot; there are at most 1 / HOT_SHARE of them, which bounds the broadcast.
HOT_SHARE = 1 / 1000


def digest(text: str = "text") -> Column:
    """SHA-256 of the text with white-space runs as one space, lowercase hex."""
    return F.sha2(F.regexp_replace(body(text), SPACE, " "), 256)


def open_index(spark: SparkSession, table: str, buckets: int | None = None) -> DataFrame:
    """The index table, made empty if it isn't there."""
    if not spark.catalog.tableExists(table):
        empty = spark.range(0).select(F.col("id").cast("string").alias("text_sha256"), F.col("id").alias("keep_id"))
        empty.write.bucketBy(buckets or partitions(spark), "text_sha256").sortBy("text_sha256").format("parquet").saveAsTable(table)
    return spark.table(table)


def index_buckets(spark: SparkSession, table: str) -> int:
    return int(next(r[1] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect() if r[0] == "Num Buckets"))


def append_new(spark: SparkSession, batch: DataFrame, table: str) -> DataFrame:
    """Append the batch's unseen digests to the index and return (text_sha256, group_size, keep_id) of the batch's digests.

    batch: (doc_id, text_sha256, n), one row per distinct pair with its count.
    """
    index, n = open_index(spark, table), index_buckets(spark, table)
    groups = batch.groupBy("text_sha256").agg(F.min("doc_id").alias("first_id"), F.sum("n").alias("group_size"))
    groups = cut(groups)
    fresh = groups.repartition(n, "text_sha256").hint("merge").join(index.hint("merge"), "text_sha256", "left_anti")
    fresh = fresh.select("text_sha256", F.col("first_id").alias("keep_id"))
    fresh.write.bucketBy(n, "text_sha256").sortBy("text_sha256").format("parquet").mode("append").saveAsTable(table)
    return groups.join(spark.table(table), "text_sha256").select("text_sha256", "group_size", "keep_id")


def exact_dedup(docs: DataFrame, table: str) -> DataFrame:
    """One row per document: doc_id, text_sha256, copy (1 for the first of rows alike in both), keep_id, group_size, kept."""
    spark = docs.sparkSession
    batch = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("text_sha256")).groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("n")))
    groups = cut(append_new(spark, batch, table))
    total = batch.agg(F.sum("n")).first()[0] or 0
    hot = groups.filter(F.col("group_size") >= max(2, total * HOT_SHARE))
    cold = groups.filter(F.col("group_size") < max(2, total * HOT_SHARE))
    marked = batch.join(F.broadcast(hot.select("text_sha256", F.col("group_size").alias("hot_size"), F.col("keep_id").alias("hot_keep"))), "text_sha256", "left")
    columns = ["doc_id", "text_sha256", "n", "keep_id", "group_size"]
    of_hot = marked.filter("hot_size is not null").withColumns({"keep_id": F.col("hot_keep"), "group_size": F.col("hot_size")}).select(columns)
    of_cold = marked.filter("hot_size is null").drop("hot_size", "hot_keep").join(cold, "text_sha256").select(columns)
    rows = of_hot.unionByName(of_cold).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    return rows.select("doc_id", "text_sha256", "copy", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"))


def keep_first(docs: DataFrame, table: str) -> DataFrame:
    """The documents that stay, with their own columns."""
    with scratch(docs.sparkSession):
        verdict = cut(exact_dedup(docs, table), keep=True)
    kept = verdict.filter("kept").select(F.col("doc_id").alias("__tl_id"), F.col("text_sha256").alias("__tl_digest"))
    rows = docs.withColumn("__tl_digest", digest())
    again = verdict.filter("copy > 1").select(F.col("doc_id").alias("__tl_id"), F.col("text_sha256").alias("__tl_digest")).distinct()

    def match(right):
        return (rows["__tl_digest"] == right["__tl_digest"]) & rows["doc_id"].cast("long").eqNullSafe(right["__tl_id"])

    if again.isEmpty():
        return rows.join(kept, match(kept), "left_semi").drop("__tl_digest")
    once = rows.join(again, match(again), "left_semi").dropDuplicates(["doc_id", "__tl_digest"])
    rest = rows.join(again, match(again), "left_anti")
    rows = rest.unionByName(once)
    return rows.join(kept, match(kept), "left_semi").drop("__tl_digest")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text, from an index that starts empty."""
    table = f"digest_index_{uuid.uuid4().hex}"
    out = exact_dedup(read_documents(spark, sf_dir), table)
    spark.sql(f"DROP TABLE {table}")  # this one was for one batch, whose verdicts stand
    return out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
