"""A corpus from raw documents to packed bins: five stages, each written as Parquet and read again by the next.

quality      documents that the PU classifier scores below its threshold go
exact_dedup  of texts equal up to white space, the smallest doc_id stays
near_dedup   SimHash over five-word shingles: of each component of near copies (Jaccard similarity 0.8 or more), the smallest
             doc_id stays
suffix_dedup passages of 50 words that also stand elsewhere are cut out of the texts, in all their copies
packing      what is left is packed into bins, no two documents of one cluster and few of one source together

Each stage is one of the operators; the near stage is operator 10 at a similarity instead of a number of bits, the suffix stage
operator 7 over words instead of bytes: a passage of 50 words has some 300 bytes, so the 400 bytes of op7 would leave it.

The first four return the columns of documents; the last returns one row per packed part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import exact_dedup, near_copies, packing, quality, suffix_dedup
from tideline.llm.common import read_documents, shared_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    table = f"digest_index_{uuid.uuid4().hex}"
    kept = exact_dedup.keep_first(docs, table)
    spark.sql(f"DROP TABLE {table}")
    return kept


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.keep_smallest(docs)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("suffix_dedup", suffix_stage),
    ("packing", packing_stage),
]

#: The classifier and the components can't be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in turn on the documents of sf_dir."""
    docs = read_documents(spark, sf_dir)
    place = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}-{name}")
        docs = spark.read.parquet(f"{place}/{number}-{name}")
    return docs
