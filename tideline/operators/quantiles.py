"""Exact order statistics and percentiles of groups of any size, without a buffer or task that grows with a group.

The aggregate `percentile` keeps every distinct value of a group. Beyond LIMIT rows a group's values are found by range
refinement instead: a histogram over the group's range tells which bucket holds a rank, the rows of that bucket alone go on,
with the rank counted within it, and so on until a bucket is small enough to be sorted or holds a single value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import written

LIMIT = 1 << 20  # rows of a group that one task may hold or sort
BUCKETS = 4096
FEW = 10_000  # groups whose ranges are broadcast


def _beside(rows: DataFrame, small: DataFrame, few: bool, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(small) if few else small.hint("merge"), ["k", "path"], how)


def select_ranks(rows: DataFrame, targets: DataFrame, limit: int = LIMIT, buckets: int = BUCKETS) -> DataFrame:
    """rows (k, v double, w long above 0), targets (k, name, t long) -> (k, name, v): of group k the least v up to which weights reach t.

    k tells groups apart and may be any type that can be grouped (a struct of several keys); v isn't null. A target above its
    group's whole weight, or below 1, has no row.
    """
    rows, targets = rows.select("k", F.lit("").alias("path"), "v", "w"), targets.select("k", F.lit("").alias("path"), "name", "t")
    out = None
    order = Window.partitionBy("k", "path").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        # of each bucket: single values and small ones are settled, large ones divided
        span = rows.groupBy("k", "path").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"), F.sum("w").alias("total")).persist()
        few = span.count() <= FEW
        single, small, large = (span.filter(c) for c in ("lo = hi", f"lo < hi and n <= {limit}", f"lo < hi and n > {limit}"))
        found = _beside(targets, single, few).filter("t between 1 and total").select("k", "name", F.col("lo").alias("v"))
        up_to = F.sum("w").over(order.orderBy("v"))
        ranked = _beside(rows, small.select("k", "path"), few, "left_semi").withColumn("up_to", up_to)
        found = found.unionByName(ranked.join(targets, ["k", "path"]).filter("t <= up_to and t > up_to - w").select("k", "name", "v"))
        out = found if out is None else out.unionByName(found)
        if large.isEmpty():
            return out
        place = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * buckets), F.lit(buckets - 1))
        dealt = _beside(rows, large, few).select("k", "path", "v", "w", place.alias("b"))
        ends = dealt.groupBy("k", "path", "b").agg(F.sum("w").alias("inside")).withColumn("up_to", F.sum("inside").over(order.orderBy("b")))  # at most `buckets` rows
        hits = targets.join(ends, ["k", "path"]).filter("t <= up_to and t > up_to - inside")
        inner = F.concat_ws("/", "path", "b").alias("path")
        targets = written(hits.select("k", inner, "name", (F.col("t") - F.col("up_to") + F.col("inside")).alias("t")))
        wanted = targets.select("k", "path").distinct()
        rows = written(_beside(dealt.select("k", inner, "v", "w"), wanted, wanted.count() <= FEW, "left_semi"))


def _key(keys: Sequence[str]) -> Column:
    return F.struct(*keys) if keys else F.lit(0)


def percentiles(df: DataFrame, keys: Sequence[str], value: str, levels: Mapping[str, float | Column], limit: int = LIMIT, buckets: int = BUCKETS) -> DataFrame:
    """(keys, a column for each level, n): interpolated percentiles, as `percentile` has them; nulls don't count, a group of nulls has none.

    A level may be a column expression of n, the group's number of values.
    """
    rows = df.select(_key(keys).alias("k"), F.col(value).cast("double").alias("v"), F.lit(1).cast("long").alias("w"))
    sizes = rows.groupBy("k").agg(F.count("v").alias("n"))
    place = lambda p: (p if isinstance(p, Column) else F.lit(float(p))) * (F.col("n") - 1)
    wanted = [F.struct(F.lit(f"{name}.{side}").alias("name"), (at(place(p)).cast("long") + 1).alias("t")) for name, p in levels.items() for side, at in (("lo", F.floor), ("hi", F.ceil))]
    targets = sizes.filter("n > 0").select("k", F.explode(F.array(*wanted)).alias("x")).select("k", "x.*")
    found = select_ranks(rows.filter("v is not null"), targets, limit, buckets)
    sides = found.groupBy("k").agg(*(F.max(F.when(F.col("name") == f"{name}.{side}", F.col("v"))).alias(f"{name}.{side}") for name in levels for side in ("lo", "hi")))
    share = {name: place(p) - F.floor(place(p)) for name, p in levels.items()}
    columns = [(F.col(f"`{n}.lo`") * (1 - share[n]) + F.col(f"`{n}.hi`") * share[n]).alias(n) for n in levels]
    return sizes.join(sides, "k", "left").select(*(F.col(f"k.{c}").alias(c) for c in keys), *columns, "n")


def grouped(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], value: str, levels: Mapping[str, float], limit: int = LIMIT, buckets: int = BUCKETS) -> DataFrame:
    """groupBy(keys).agg(aggregates and percentiles of value): one aggregate where every group is small, else by refinement.

    df is read more than once, so it should be kept.
    """
    keys = list(keys)
    sizes = df.groupBy(*keys).agg(F.count(value).alias("n"))
    if sizes.filter(F.col("n") > limit).isEmpty():
        return df.groupBy(*keys).agg(*aggregates, *(F.percentile(value, p).alias(name) for name, p in levels.items()))
    found = percentiles(df, keys, value, levels, limit, buckets).drop("n")
    if not aggregates:
        return found
    plain = df.groupBy(*keys).agg(*aggregates)
    if not keys:
        return plain.crossJoin(F.broadcast(found))  # one row each
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"q.{c}")) for c in keys]
    return plain.alias("p").join(found.alias("q"), same).select("p.*", *(F.col(f"q.{name}") for name in levels))


def weighted_quantiles(df: DataFrame, keys: Sequence[str], value: str, weight: str, levels: Mapping[str, float], limit: int = LIMIT, buckets: int = BUCKETS) -> DataFrame:
    """(keys, a column for each level): the least value up to which a group's weights reach the level's share of their sum.

    Weights are whole numbers (long), so that their sums are the same in any order.
    """
    rows = df.select(_key(keys).alias("k"), F.col(value).cast("double").alias("v"), F.col(weight).alias("w")).filter("v is not null and w > 0")
    total = rows.groupBy("k").agg(F.sum("w").alias("total"))
    wanted = [F.struct(F.lit(name).alias("name"), F.greatest(F.ceil(F.lit(float(p)) * F.col("total")), F.lit(1)).cast("long").alias("t")) for name, p in levels.items()]
    found = select_ranks(rows, total.select("k", F.explode(F.array(*wanted)).alias("x")).select("k", "x.*"), limit, buckets)
    out = found.groupBy("k").agg(*(F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in levels))
    return out.select(*(F.col(f"k.{c}").alias(c) for c in keys), *levels)
