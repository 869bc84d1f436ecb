"""Uncertainty of paired series: moving-block bootstrap by prefix sums, Newey-West variance, Diebold-Mariano test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timefn as fn
from ..operators.series import numbered, running_sums


def block_starts(spark, n: int, length: int, resamples: int, seed: str = "blocks") -> DataFrame:
    """(r, b, start, size): hashed starts, uniform on 0 .. n - length, of the blocks of each resample; the last one is cut to n."""
    blocks = -(-n // length)
    grid = spark.range(resamples).select(F.col("id").alias("r")).withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    digest = F.md5(F.concat_ws("-", F.lit(seed), "r", "b"))
    start = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % (n - length + 1)
    return grid.select("r", "b", start.alias("start"), F.least(F.lit(length), F.lit(n) - F.col("b") * length).alias("size"))


def saving_intervals(days: DataFrame, rules: Sequence[str], bases: Sequence[str], length: int = 7, resamples: int = 2000, level: float = 0.95) -> DataFrame:
    """(rule, base, estimate, lower, upper, days): 100 * (1 - mean(rule) / mean(base)) with a percentile interval over resamples of blocks.

    days: (i, the columns). Every pair of columns is drawn with the same blocks, in one pass. Block sums are differences of running
    sums, so resamples * blocks rows are made, not resamples * n.
    """
    columns = list(dict.fromkeys([*rules, *bases]))
    n = days.count()
    if not 1 <= length <= n:
        raise ValueError("the block length must be between 1 and the number of rows")
    days = days.select("i", *(F.col(c).cast("double").alias(c) for c in columns))
    sums = running_sums(days, "i", columns).withColumn("i", F.col("i") + 1)
    sums = sums.unionByName(days.sparkSession.range(1).select(F.lit(0).cast("long").alias("i"), *(F.lit(0.0).alias(c) for c in columns)))
    blocks = block_starts(days.sparkSession, n, length, resamples).withColumn("stop", F.col("start") + F.col("size"))
    low, high = (sums.select(F.col("i").alias(at), *(F.col(c).alias(f"{at}_{c}") for c in columns)) for at in ("start", "stop"))
    drawn = blocks.join(low, "start").join(high, "stop").groupBy("r").agg(*(F.sum(F.col(f"stop_{c}") - F.col(f"start_{c}")).alias(c) for c in columns))
    pairs = [(rule, base) for rule in rules for base in bases]
    saving = [F.lit(100.0) * (1 - F.col(rule) / F.col(base)) for rule, base in pairs]
    tail = (1 - level) / 2
    spread = drawn.agg(F.array(*(F.percentile(s, [tail, 1 - tail]) for s in saving)).alias("spread"))
    estimate = days.agg(F.array(*(F.lit(100.0) * (1 - F.avg(rule) / F.avg(base)) for rule, base in pairs)).alias("estimate"))
    names = F.array(*(F.struct(F.lit(rule).alias("rule"), F.lit(base).alias("base")) for rule, base in pairs))
    rows = estimate.crossJoin(F.broadcast(spread)).select(F.explode(F.arrays_zip(names.alias("pair"), "estimate", "spread")).alias("x"))
    return rows.select("x.pair.rule", "x.pair.base", "x.estimate", F.col("x.spread")[0].alias("lower"), F.col("x.spread")[1].alias("upper"), F.lit(n).alias("days"))


def saving_interval(pairs: DataFrame, length: int = 7, resamples: int = 2000, level: float = 0.95) -> DataFrame:
    """(estimate, lower, upper, days) for pairs (i, rule, base)."""
    return saving_intervals(pairs, ["rule"], ["base"], length, resamples, level).drop("rule", "base")


def newey_west(values: DataFrame, lags: int, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, mean, variance): long-run variance of (i, x) with Bartlett weights, by one equi-join over the lags."""
    keys = list(keys)
    mean = values.groupBy(*keys).agg(F.avg("x").alias("mean"), F.count(F.lit(1)).alias("n"))
    known = values.join(mean, keys) if keys else values.crossJoin(F.broadcast(mean))
    c = known.select(*keys, "i", "n", "mean", (F.col("x") - F.col("mean")).alias("c"))
    ahead = c.select(*keys, F.col("c").alias("c0"), F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("lag"), (F.col("i")).alias("i0")).withColumn("i", F.col("i0") + F.col("lag"))
    products = ahead.join(c, [*keys, "i"]).groupBy(*keys, "lag").agg(F.sum(F.col("c0") * F.col("c")).alias("s"), F.max("n").alias("n"), F.max("mean").alias("mean"))
    weight = F.when(F.col("lag") == 0, 1.0).otherwise(2 * (1 - F.col("lag") / (lags + 1.0)))
    return products.groupBy(*keys).agg(F.max("n").alias("n"), F.max("mean").alias("mean"), F.sum(weight * F.col("s") / F.col("n")).alias("variance"))


def diebold_mariano(losses: DataFrame, lags: int = 7, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, n, mean_difference, statistic, p_value) for (i, a, b): are two forecasts equally good? Null where it is undefined."""
    v = newey_west(losses.select(*keys, "i", (F.col("a") - F.col("b")).alias("x")), lags, keys)
    ok = (F.col("n") >= lags + 2) & (F.col("variance") > 0)
    statistic = F.when(ok, F.col("mean") / F.sqrt(F.col("variance") / F.col("n")))
    return v.select(*keys, "n", F.col("mean").alias("mean_difference"), "variance", statistic.alias("statistic")).withColumn("p_value", fn.erfc(F.abs("statistic") / F.sqrt(F.lit(2.0))))


def daily_pairs(raw) -> DataFrame:
    """(i, rule, base) from the orders: the day's mean value of even-numbered orders against that of all."""
    o = raw.table("orders").select(F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 2 == 0).alias("even"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    n = F.count(F.when(F.col("even"), 1))
    d = o.groupBy("day").agg((F.sum(F.when(F.col("even"), F.col("cents"))) / F.nullif(100 * n, F.lit(0))).alias("rule"), (F.sum("cents") / (100 * F.count(F.lit(1)))).alias("base"))
    return numbered(d.filter("rule is not null"), "day")
