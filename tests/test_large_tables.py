"""What must not grow with the tables: what passes the driver."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline.plans import forecasting as fc
from tideline.sources.bound import Bound

DIR = Path("/root/testdata/sf0.001")


def broadcasts(df) -> int:
    """Broadcasts of the plan as it ran."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("BroadcastExchange ")


def test_series_and_features_are_not_broadcast(spark):
    """A series of a row a half-hour, its calendar and what is known at each index stay on the executors, however small (F1)."""
    ts = F.timestamp_add("MINUTE", (F.col("id") * 30).cast("int"), F.lit("2024-01-01").cast("timestamp_ntz"))
    series = spark.range(1500).select(F.col("id").alias("idx"), ts.alias("ts"), (F.col("id") % 71).cast("double").alias("actual"), (F.col("id") % 53).cast("double").alias("forecast")).localCheckpoint()
    cal = fc.calendar(series, spark.sql("select date'2024-01-01' as day")).localCheckpoint()
    origins = series.filter("idx % 48 = 47 and idx between 700 and 1300").select("idx", "ts", F.col("ts").alias("issue"), F.lit(0).alias("fold")).localCheckpoint()
    assert broadcasts(fc.features(series, cal, origins)) == 1  # the 96 horizons
    rows = fc.stand_in(fc.features(series, cal, origins).localCheckpoint())
    assert broadcasts(fc.prediction_table(rows, origins, series)) == 1  # the issues, a row a day


def test_customers_are_not_broadcast(spark):
    """Of the yearly country table only the nations are (F3)."""
    if not DIR.is_dir():
        pytest.skip("no test tables")
    assert broadcasts(Bound(spark, str(DIR)).yearly) == 1
