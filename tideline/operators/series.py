"""Operators over regular series: spine, windows that span partitions, index gathers, cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 4096  # rows of a series that one window partition holds


def spine(df: DataFrame, keys: Sequence[str], ts: str, chunk: int = CHUNK) -> DataFrame:
    """One row per half-hour between each key's first and last time; made chunk by chunk, so no row holds a whole series."""
    bounds = df.groupBy(*keys).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).filter("lo is not null")
    begins = bounds.select(*keys, "hi", F.explode(F.sequence("lo", "hi", F.expr(f"INTERVAL {30 * chunk} MINUTES"))).alias("lo"))
    end = F.least("hi", F.col("lo") + F.expr(f"INTERVAL {30 * (chunk - 1)} MINUTES"))
    return begins.select(*keys, F.explode(F.sequence("lo", end, F.expr("INTERVAL 30 MINUTES"))).alias(ts))


def on_spine(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Observations on their spine; `seen` tells present rows from filled ones."""
    return spine(df, keys, ts).join(df.withColumn("seen", F.lit(True)).hint("merge"), [*keys, ts], "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def in_range(value: str, lo: float, hi: float) -> tuple[Column, Column]:
    """(value or null, whether it was outside): implausible values are nulled and flagged, never dropped."""
    ok = F.col(value).between(lo, hi)
    return F.when(ok, F.col(value)), F.coalesce(~ok, F.lit(False))


def halo(df: DataFrame, index: str, before: int, after: int, chunk: int = CHUNK) -> DataFrame:
    """Rows dealt to chunks of the index, with copies for neighbours whose window reaches them.

    A window over a whole series would put it in one task; over (series, part) it is bounded. Keep rows where `own`.
    """
    i = F.col(index)
    reach = [F.floor(i / chunk)]
    reach += [F.floor((i - after) / chunk)] if after else []
    reach += [F.floor((i + before) / chunk)] if before else []
    out = df.withColumn("part", F.explode(F.array_distinct(F.array(*reach))))
    return out.withColumn("own", F.col("part") == F.floor(i / chunk))


def rolling(df: DataFrame, keys: Sequence[str], index: str, before: int, after: int, columns: dict, chunk: int = CHUNK) -> DataFrame:
    """Adds window aggregates over rows index-before .. index+after; columns: name -> aggregate Column."""
    w = Window.partitionBy(*keys, "part").orderBy(index).rowsBetween(-before, after)
    spread = halo(df, index, before, after, chunk)
    return spread.withColumns({k: c.over(w) for k, c in columns.items()}).filter("own").drop("part", "own")


def gather(df: DataFrame, series: DataFrame, keys: Sequence[str], at: Column, value: str, name: str, index: str = "idx") -> DataFrame:
    """Adds the series' value at index `at` (null beyond its ends). A series is never broadcast: it would pass the driver whole."""
    right = series.select(*keys, F.col(index).alias("_at"), F.col(value).alias(name)).hint("merge")
    return df.withColumn("_at", at).join(right, [*keys, "_at"], "left").drop("_at")


def pick_lowest(label: str, by: str) -> Column:
    """The label of the lowest `by`, the smallest label among ties, in one hash aggregate."""
    return F.min_by(F.col(label), F.when(F.col(by).isNotNull(), F.struct(by, label)))


def complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with neither null nor NaN in any of the columns."""
    out = df.dropna(subset=list(columns))
    kinds = dict(df.dtypes)
    for c in columns:
        if kinds[c] in ("double", "float"):
            out = out.filter(~F.isnan(c))
    return out


def keep_last(df: DataFrame, keys: Sequence[str], arrival: str) -> DataFrame:
    """Of rows with one key the last arrival, whole row, by a partial aggregate."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(arrival)).alias("_row"))
    return picked.select(*keys, "_row.*").select(df.columns)


def following(df: DataFrame, keys: Sequence[str], ts: str, name: str = "next_ts") -> DataFrame:
    """Adds the next row's time. Windows are over a month of a key; months are chained by the first time of the next one."""
    df = df.withColumn("_month", F.trunc(F.to_date(ts), "month"))
    first = df.groupBy(*keys, "_month").agg(F.min(ts).alias("_first"))
    order = Window.partitionBy(*keys).orderBy("_month")  # a row a month
    chain = first.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.col("_month").alias("_m"), F.lead("_first").over(order).alias("_then"))
    same = F.col("_month") == F.col("_m")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = F.lead(ts).over(Window.partitionBy(*keys, "_month").orderBy(ts))
    out = df.withColumn("_inside", inside).join(chain, same, "left").withColumn(name, F.coalesce("_inside", "_then"))
    return out.drop("_month", "_m", "_then", "_inside", *(f"_k_{k}" for k in keys))


def regular(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Rows after which the next one isn't 30 minutes later: empty for a regular series."""
    return following(df, keys, ts).filter(F.col("next_ts").isNotNull() & (F.col("next_ts") != F.col(ts) + F.expr("INTERVAL 30 MINUTES")))


def numbered(df: DataFrame, order: str, keys: Sequence[str] = ()) -> DataFrame:
    """Adds i = 0, 1, ... for each key in the order of a day or time, which doesn't repeat; counted by month, so no task orders a whole series."""
    df = df.withColumn("_month", F.trunc(F.to_date(order), "month"))
    counts = df.groupBy(*keys, "_month").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_month").rowsBetween(Window.unboundedPreceding, -1))  # a row a month
    starts = counts.select(*keys, "_month", F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*keys, "_month").orderBy(order)) - 1
    return df.withColumn("i", place).join(starts, [*keys, "_month"]).withColumn("i", (F.col("i") + F.col("_start")).cast("long")).drop("_month", "_start")


def running_sums(df: DataFrame, index: str, columns: Sequence[str], chunk: int = CHUNK) -> DataFrame:
    """The columns' sums up to and with each row: windows over chunks of the index, and the totals of the chunks before."""
    df = df.withColumn("_part", F.floor(F.col(index) / chunk))
    totals = df.groupBy("_part").agg(*(F.sum(c).alias(c) for c in columns))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    carried = totals.select("_part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_{c}") for c in columns))
    inside = Window.partitionBy("_part").orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    out = df.withColumns({c: F.sum(c).over(inside) for c in columns}).join(carried, "_part")
    return out.withColumns({c: F.col(c) + F.col(f"_{c}") for c in columns}).drop("_part", *(f"_{c}" for c in columns))


def indexed(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Adds idx, the row's place on its series' half-hour grid."""
    first = df.groupBy(*keys).agg(F.min(ts).alias("_first"))
    joined = df.join(first, list(keys)) if keys else df.crossJoin(F.broadcast(first))  # without keys one row
    return joined.withColumn("idx", ((F.unix_timestamp(ts) - F.unix_timestamp("_first")) / 1800).cast("long")).drop("_first")
