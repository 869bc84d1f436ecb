"""Quantile boosting, forecasts of many series and folds on shared features."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from tideline.plans import boosting
from tideline.plans import forecasting as fc

from .test_series import HOLIDAYS, half_hours


@pytest.fixture(scope="module")
def rows(spark):
    """Noise whose width grows with a feature, so that bounds have to follow it."""
    from pyspark.ml.feature import VectorAssembler

    rng = random.Random(4)
    made = []
    for i in range(3000):
        a, b = rng.random(), float(rng.randint(0, 3))
        made.append((i, a, b, 10 * a + rng.gauss(0, 1 + 4 * (b == 2)), rng.choice((0.5, 1.0, 2.0))))
    df = spark.createDataFrame(made, "i long, a double, b double, y double, w double")
    return VectorAssembler(inputCols=["a", "b"], outputCol="x").transform(df).repartition(2).cache()


def least(pairs, level):
    """The least value up to which weights reach the level's share."""
    pairs = sorted(pairs)
    run, total = 0, sum(w for _, w in pairs)
    for v, w in pairs:
        run += w
        if run >= max(1, math.ceil(level * total)):
            return v


@pytest.mark.parametrize("limit", [boosting.LIMIT, 100])
def test_leaves_hold_quantiles(spark, rows, monkeypatch, limit):
    """Start and first leaves against brute force, by sorting and by refinement."""
    monkeypatch.setattr(boosting, "LIMIT", limit)
    part = rows.filter("i < 800")
    fitted = boosting.PinballTrees((0.1, 0.9), 1, 0.5, 3).fit(part, "x", "y", "w")
    data = [(r.y, max(1, round(r.w * boosting.WHOLE))) for r in part.collect()]
    assert fitted.start == [least(data, 0.1), least(data, 0.9)]
    tree, values = fitted.model[0]
    for k, level in enumerate((0.1, 0.9)):
        fallen = tree.transform(fitted._assembled(part, "x", F.lit(k), "_x"), {tree.featuresCol: "_x", tree.leafCol: "leaf"}).collect()
        for leaf in {int(r.leaf) for r in fallen}:
            assert values[k][leaf] == pytest.approx(least([(r.y - fitted.start[k], max(1, round(r.w * boosting.WHOLE))) for r in fallen if r.leaf == leaf], level))
    shown = fitted.predict(part, "x", ("lo", "hi"))
    assert shown.columns == [*part.columns, "lo", "hi"] and shown.filter("lo is null or hi is null").isEmpty()


def test_rows_are_written_once_in_many_rounds(spark, rows, monkeypatch, tmp_path):
    """Rounds between two writings go on from kept rows, to the same bounds, and leave neither rows nor files behind."""
    places = []
    plain = boosting.written
    monkeypatch.setattr(boosting, "shared", lambda spark: str(tmp_path / f"rows{len(places)}"))
    monkeypatch.setattr(boosting, "written", lambda df, place: (places.append(place), plain(df, place))[1])
    found = []
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    for every in (1, 2, 8):
        places.clear()
        monkeypatch.setattr(boosting, "WRITTEN", every)
        fitted = boosting.PinballTrees((0.1, 0.9), 4, 0.5, 2).fit(rows.filter("i < 800"), "x", "y", "w")
        found.append((fitted.start, [values for _, values in fitted.model]))
        assert len(places) == {1: 4, 2: 2, 8: 1}[every]
        assert not any(tmp_path.iterdir())
    assert found[0] == found[1] == found[2]
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_bounds_cover_before_widening(rows):
    fitted = boosting.PinballTrees((0.1, 0.9), 10, 0.4, 4).fit(rows.filter("i < 2200"), "x", "y", "w")
    held = fitted.predict(rows.filter("i >= 2200"), "x", ("lo", "hi"))
    share = F.avg((F.col("y").between(F.col("lo"), F.col("hi"))).cast("double"))
    wide, narrow = (held.filter(c).agg(share.alias("s"), F.avg(F.col("hi") - F.col("lo")).alias("w")).first() for c in ("b = 2", "b <> 2"))
    assert abs(held.agg(share).first()[0] - 0.8) < 0.05
    assert wide.w > 2 * narrow.w and abs(wide.s - 0.8) < 0.12 and abs(narrow.s - 0.8) < 0.08


def test_too_little_history_says_so(spark):
    s = half_hours(spark, 18)
    with pytest.raises(fc.TooLittleHistory):
        fc.Forecaster().fit(fc.training_rows(s, fc.calendar(s, spark.createDataFrame([], HOLIDAYS)), 860))


def test_many_series_are_each_as_alone(spark):
    """Series of unlike lengths and starts in one table: features, origins with folds, training rows."""
    keys, holidays = ["k"], spark.createDataFrame([(dt.date(2025, 1, 6), "x")], HOLIDAYS)
    alone = {k: half_hours(spark, n).withColumn("actual", F.when(F.col("idx") % 97 != k, F.col("actual") + 10 * k)) for k, n in ((1, 24), (2, 30), (3, 19))}
    alone[3] = alone[3].withColumn("ts", F.col("ts") + F.expr("INTERVAL 36 HOURS"))
    many = None
    for k, s in alone.items():
        part = s.withColumn("k", F.lit(k))
        many = part if many is None else many.unionByName(part)
    many = many.cache()
    cal, origins = fc.calendar(many, holidays, keys=keys), fc.daily_origins(many, 9, 0, 4, keys=keys)
    all_features = fc.features(many, cal, origins, keys=keys).cache()
    folds = fc.cutoffs(origins, keys)
    all_training = fc.training_rows(many, cal, folds, keys=keys).cache()
    rounded = lambda df: df.select(*(F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
    for k, s in alone.items():
        one_cal, one_origins = fc.calendar(s, holidays), fc.daily_origins(s, 9, 0, 4)
        a, b = rounded(fc.features(s, one_cal, one_origins)), rounded(all_features.filter(F.col("k") == k).drop("k"))
        assert a.count() == b.count() > 0 and a.exceptAll(b).isEmpty()
        assert sorted(one_origins.collect()) == sorted(origins.filter(F.col("k") == k).drop("k").collect())
        last = one_origins.agg(F.max("fold")).first()[0]
        cutoff = one_origins.filter(F.col("fold") == last).agg(F.min("idx")).first()[0]
        a = rounded(fc.training_rows(s, one_cal, cutoff).select("origin", "target", "change", "weight", "calibrates", *fc.FEATURES))
        b = rounded(all_training.filter((F.col("k") == k) & (F.col("fold") == last)).select("origin", "target", "change", "weight", "calibrates", *fc.FEATURES))
        assert a.count() == b.count() and a.exceptAll(b).isEmpty()


class Raw:
    def __init__(self, spark):
        self.spark, self.holidays = spark, spark.createDataFrame([], HOLIDAYS)


def test_folds_share_one_feature_table(spark, monkeypatch):
    """Two folds: features are made once, and each fold's forecasts are those of a fit of its own."""

    class Given:
        raw = Raw(spark)

    series = half_hours(spark, 27).cache()
    monkeypatch.setattr(fc, "national_series", lambda w: series)
    calls = []
    plain = fc.features
    monkeypatch.setattr(fc, "features", lambda *a, **k: (calls.append(1), plain(*a, **k))[1])
    s = fc.Settings(least_rows=400, trees=2, depth=2, rate=0.5, bound_trees=1, calibration_days=3)
    out = fc.backtest(Given(), s, days=4, retrain=2).cache()
    assert out.groupBy("fold").count().count() == 2 and len(calls) == 1
    cal = fc.calendar(series, Given.raw.holidays)
    origins = fc.daily_origins(series, 4, 0, 2, least=fc.first_cutoff(s))
    for r in fc.cutoffs(origins).collect():
        model = fc.Forecaster(s).fit(fc.training_rows(series, cal, r.cutoff, s))
        want = model.predict(plain(series, cal, origins.filter(F.col("fold") == r.fold)))
        want = {(x.origin, int(x.horizon)): (x.model, x.model_p10, x.model_p90) for x in want.collect()}
        times = {x.issue: x.idx for x in origins.collect()}
        got = {(times[x.issue], x.horizon): (x.model, x.model_p10, x.model_p90) for x in out.filter(F.col("fold") == r.fold).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], rel=1e-6) for k in want)
