"""Half-open intervals of time: gaps, merging, coverage plans, chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timefn as fn
from .series import following


def gaps(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """(keys, start_ts, end_ts, missing): holes between consecutive distinct times of each key."""
    times = following(df.select(*keys, ts).distinct(), keys, ts, "end_ts")
    out = times.select(*keys, (F.col(ts) + F.expr("INTERVAL 30 MINUTES")).alias("start_ts"), "end_ts")
    return out.filter("end_ts > start_ts").withColumn("missing", (fn.minutes_between("start_ts", "end_ts") / 30).cast("int"))


def merge(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Overlapping or touching intervals of each key become one; without keys all of them.

    They are dealt to the months in which they begin. A month is scanned by itself, given how far those before it reach.
    """
    df = df.withColumn("_month", F.trunc(F.to_date("start_ts"), "month"))
    months = df.groupBy(*keys, "_month").agg(F.max("end_ts").alias("_far"))
    earlier = Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1)  # a row a month
    months = months.withColumn("_reach", F.max("_far").over(earlier)).drop("_far")
    w = Window.partitionBy(*keys, "_month").orderBy("start_ts", "end_ts")
    reach = F.greatest("_reach", F.max("end_ts").over(w.rowsBetween(Window.unboundedPreceding, -1)))  # skips nulls
    islands = df.join(months, [*keys, "_month"]).withColumn("_fresh", F.when(reach.isNull() | (F.col("start_ts") > reach), 1).otherwise(0))
    islands = islands.withColumn("_island", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # numbered through all months; what goes on from an earlier month (island 0) gets the number of the last one before it
    made = islands.groupBy(*keys, "_month").agg(F.sum("_fresh").alias("_made"))
    made = made.withColumn("_before", F.coalesce(F.sum("_made").over(earlier), F.lit(0))).drop("_made")
    whole = islands.join(made, [*keys, "_month"]).withColumn("_whole", F.col("_before") + F.col("_island"))
    return whole.groupBy(*keys, "_whole").agg(F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts")).drop("_whole")


def to_fetch(bounds: DataFrame, keys: Sequence[str], start: str, now: str, refetch_days: int = 2) -> DataFrame:
    """What is still to be read for each key with bounds (lo, hi): all of it, an earlier start, and always the last days anew."""
    begin, end = F.lit(start).cast("timestamp_ntz"), F.lit(now).cast("timestamp_ntz")
    last = F.greatest(begin, F.least(F.col("hi") + F.expr("INTERVAL 30 MINUTES"), end) - F.expr(f"INTERVAL {refetch_days} DAYS"))
    whole = F.array(F.struct(begin.alias("start_ts"), end.alias("end_ts")))
    parts = F.array(
        F.struct(begin.alias("start_ts"), F.col("lo").alias("end_ts")),
        F.struct(last.alias("start_ts"), end.alias("end_ts")),
    )
    plan = F.when(F.col("lo").isNull(), whole).otherwise(parts)
    return bounds.select(*keys, F.explode(plan).alias("w")).select(*keys, "w.*").filter("start_ts < end_ts")


def chunks(df: DataFrame, keys: Sequence[str], max_days: int) -> DataFrame:
    """Intervals cut to at most max_days, and where a year ends."""
    first_year, last_year = F.year(F.col("start_ts") + F.expr("INTERVAL 30 MINUTES")), F.year("end_ts")
    years = F.transform(
        F.sequence(first_year, F.greatest(first_year, last_year)),
        lambda y: F.make_timestamp_ntz(y + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) - F.expr("INTERVAL 30 MINUTES"),
    )
    inside = F.filter(years, lambda t: (t > F.col("start_ts")) & (t < F.col("end_ts")))
    pieces = df.withColumn("cuts", F.array_sort(F.array_distinct(F.concat(F.array("start_ts"), inside, F.array("end_ts")))))
    pieces = pieces.withColumn("piece", F.explode(F.arrays_zip(F.slice("cuts", 1, F.size("cuts") - 1).alias("a"), F.slice("cuts", 2, F.size("cuts") - 1).alias("b"))))
    pieces = pieces.select(*keys, F.col("piece.a").alias("a"), F.col("piece.b").alias("b"))
    steps = F.sequence("a", F.col("b") - F.expr("INTERVAL 1 MICROSECOND"), F.expr(f"INTERVAL {max_days} DAYS"))
    out = pieces.select(*keys, "b", F.explode(steps).alias("start_ts"))
    return out.select(*keys, "start_ts", F.least(F.col("start_ts") + F.expr(f"INTERVAL {max_days} DAYS"), "b").alias("end_ts"))


def plan(df: DataFrame, keys: Sequence[str], dataset: str, limits: dict[str, int]) -> DataFrame:
    """Intervals of several datasets cut by each dataset's own limit of days; a dataset without a limit is an error."""
    unknown = df.select(dataset).distinct().filter(~F.col(dataset).isin(*limits)).limit(1).collect()
    if unknown:
        raise ValueError(f"no limit for {unknown[0][0]}")
    parts = [chunks(df.filter(F.col(dataset) == name), list(dict.fromkeys([dataset, *keys])), days) for name, days in limits.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
