"""Order statistics by range refinement against sorting."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import quantiles


def numbers():
    """Groups of many shapes: ties, one value, an outlier beyond all others, one row, only nulls, a null key."""
    rng = random.Random(8)
    shapes = {"even": [rng.random() for _ in range(400)], "ties": [float(rng.randint(0, 5)) for _ in range(300)], "one": [7.5] * 200, "outlier": [1e300, -1e12, *(rng.random() * 1e-6 for _ in range(250))], "single": [3.0], "few": [2.0, 1.0, 2.5], "none": [None, None], None: [rng.gauss(0, 1) for _ in range(120)] + [None] * 30}
    return [(k, i % 2, x) for k, values in shapes.items() for i, x in enumerate(values)]


@pytest.mark.parametrize("limit,buckets", [(16, 32), (10**6, 4096)])
def test_percentiles_equal_the_aggregate(spark, limit, buckets):
    df = spark.createDataFrame(numbers(), "k string, half int, x double").repartition(5).cache()
    levels = {"a": 0.0, "p10": 0.1, "mid": 0.5, "p97": 0.97, "z": 1.0}
    for keys in (["k", "half"], []):
        want = {tuple(r[: len(keys)]): r[len(keys) :] for r in map(tuple, df.groupBy(*keys).agg(*(F.percentile("x", p) for p in levels.values())).collect())}
        got = {tuple(r[: len(keys)]): r[len(keys) :] for r in map(tuple, quantiles.percentiles(df, keys, "x", levels, limit, buckets).drop("n").collect())}
        assert got.keys() == want.keys()
        for k, values in want.items():
            assert all((a is None and b is None) or a == pytest.approx(b, rel=1e-12) for a, b in zip(got[k], values)), k
    both = quantiles.grouped(df, ["k"], [F.count("x").alias("n"), F.avg("x").alias("m")], "x", levels, limit, buckets)
    assert both.columns == ["k", "n", "m", *levels] and {r.k: r.n for r in both.collect()} == {r.k: r.n for r in df.groupBy("k").agg(F.count("x").alias("n")).collect()}


@pytest.mark.parametrize("limit", [10, 10**6])
def test_weighted_quantiles(spark, limit):
    rng = random.Random(3)
    rows = [(k, round(rng.gauss(0, 3), 1), rng.choice((0, 1, 5, 1000))) for k in "abc" for _ in range(150)]
    df = spark.createDataFrame(rows, "k string, v double, w long").repartition(4)
    found = {r.k: (r.lo, r.hi) for r in quantiles.weighted_quantiles(df, ["k"], "v", "w", {"lo": 0.1, "hi": 0.9}, limit, 8).collect()}
    for k in "abc":
        mine = sorted((v, w) for c, v, w in rows if c == k and w)
        total = sum(w for _, w in mine)
        for p, got in zip((0.1, 0.9), found[k]):
            run = 0
            for v, w in mine:
                run += w
                if run >= math.ceil(p * total):
                    break
            assert got == v


def test_a_large_group_is_never_sorted_whole(spark):
    """A window sees the rows of one bucket alone."""
    df = spark.range(200_000).select((F.hash("id") % 1_000_000).cast("double").alias("x")).cache()
    out = quantiles.percentiles(df, [], "x", {"p": 0.5}, limit=1000, buckets=512)
    assert out.first().p == df.agg(F.percentile("x", 0.5)).first()[0]
    rows = df.select(F.lit(0).alias("k"), F.col("x").alias("v"), F.lit(1).cast("long").alias("w"))
    targets = spark.createDataFrame([(0, "m", 100_000)], "k int, name string, t long")
    found = quantiles.select_ranks(rows, targets, 1000, 512)
    assert found.first().v == sorted(r.x for r in df.collect())[99_999]
