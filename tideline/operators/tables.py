"""Places in the folder that driver and executors share, and results written there to go on from."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared(spark: SparkSession) -> str:
    """A new place in the folder that driver and executors share (spark.checkpoint.dir); local sessions may go without the setting."""
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not place:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        place = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(place)
    return f"{place}/{uuid.uuid4().hex}"


def written(df: DataFrame, place: str | None = None) -> DataFrame:
    """The rows, written (to a new shared place unless one is given) and read again: plans after it start from the files."""
    place = place or shared(df.sparkSession)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def files(spark: SparkSession, path: str):
    """The file system of a path, and the path in its form."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = files(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    fs, place = files(spark, path)
    fs.delete(place, True)
