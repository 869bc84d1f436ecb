"""Multi-horizon forecasting on the half-hour grid: features, baselines, boosted trees, calibration, backtests, scores.

A series is a long DataFrame (idx, ts, actual, forecast) on its spine; with `keys`, many series stand in one table, told apart by
key columns, and cutoffs, folds and last indices are columns joined to them. Gathers by index are equi-joins on (keys, idx), trailing
statistics are windows over (keys, chunk) computed once, and every feature of an (origin, horizon) pair uses rows up to the origin only.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ..functions import timefn as fn
from ..operators import series as ops
from ..operators.quantiles import percentiles
from ..operators.tables import written
from ..sources.sinks import write_run
from .boosting import PinballTrees
from .warehouse import Warehouse, error_metrics

DAY, WEEK, AHEAD = 48, 336, 96


class TooLittleHistory(ValueError):
    """A series has too few usable rows to train on."""


# Features, by the function that makes them and in the order in which it does. Those in the series' own unit are also taken relative
# to the last value.
CALENDAR = {
    "slot": lambda: fn.slot("local").cast("double"),
    "weekday": lambda: F.weekday("day").cast("double"),
    "holiday": lambda: F.coalesce("holiday", F.lit(0.0)),
    "doy_sin": lambda: F.sin(fn.year_angle("day")),
    "doy_cos": lambda: F.cos(fn.year_angle("day")),
}
# of the series up to the origin: name -> (half-hours, statistic, whether it is in the series' unit)
WINDOWS = {
    "mean_24h": (DAY, F.avg, True),
    "min_24h": (DAY, F.min, True),
    "max_24h": (DAY, F.max, True),
    "std_24h": (DAY, F.stddev_pop, False),
    "mean_7d": (WEEK, F.avg, True),
}
STEPS_BACK = {"previous": 1}  # values before the origin
SLOT = ("latest_slot", "slot_profile")  # of the target's time of day
WEEKS_BACK = {"back_1w": 1, "back_2w": 2}  # values before the target
RELATIVE = (*(n for n, (_, _, level) in WINDOWS.items() if level), *STEPS_BACK, *SLOT, *WEEKS_BACK)
FEATURES = ("last", *STEPS_BACK, *WINDOWS, "change_24h", *SLOT, *WEEKS_BACK, *(f"{n}_rel" for n in RELATIVE), *CALENDAR, "horizon")
# Bands of leads and names of methods, as they stand in the results.
BANDS = (("0-24 h", 1, 48), ("24-48 h", 49, 96), ("0-48 h", 1, 96))
LEADS = (("0-1 h", 1, 2), ("1-4 h", 3, 8), ("4-12 h", 9, 24), ("12-24 h", 25, 48), ("24-36 h", 49, 72), ("36-48 h", 73, 96))
ROWS_A_TASK = 50_000  # training rows that a task of a fit sees
METHODS = ("model", "persistence", "naive_yesterday", "naive_last_week", "api_forecast")


@dataclass(frozen=True)
class Settings:
    train_days: int = 730
    origin_step: int = 12
    calibration_days: int = 56
    coverage: float = 0.8
    least_rows: int = 1000
    least_calibration: int = 200
    trees: int = 300
    depth: int = 5
    rate: float = 0.05
    bound_trees: int = 40  # each fits the bounds anew to exact leaf quantiles, so fewer and larger steps do
    bound_rate: float = 0.2


def national_series(w: Warehouse) -> DataFrame:
    s = ops.indexed(w.half_hours.select("ts", "actual", "forecast"), [], "ts")
    return s.select("idx", "ts", F.col("actual").cast("double").alias("actual"), F.col("forecast").cast("double").alias("forecast"))


def before(series: DataFrame, until: str) -> DataFrame:
    """The series cut off before a time; it must not be empty."""
    out = series.filter(F.col("ts") < F.lit(until).cast("timestamp_ntz"))
    if out.isEmpty():
        raise ValueError(f"no half-hours before {until}")
    return out


def regional_series(w: Warehouse) -> DataFrame:
    """Every region's values on its own grid, a series each; the source's forecast is the national one."""
    regions = ops.on_spine(w.raw.regional.select("region_id", "ts", F.col("forecast").cast("double").alias("actual")), ["region_id"], "ts").drop("seen")
    source = w.raw.national.select("ts", F.col("forecast").cast("double").alias("forecast"))
    return ops.indexed(regions.join(source, "ts", "left"), ["region_id"], "ts").select("region_id", "idx", "ts", "actual", "forecast")


def _beside(rows: DataFrame, of_series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with what is known of their series: a row for each, or a single one without keys."""
    return rows.join(of_series, list(keys)) if keys else rows.crossJoin(F.broadcast(of_series))


def calendar(series: DataFrame, holidays: DataFrame, ahead: int = AHEAD, keys: Sequence[str] = ()) -> DataFrame:
    """CALENDAR of local times, for each series and `ahead` half-hours past its end."""
    end = series.groupBy(*keys).agg(F.max("idx").alias("_i"), F.max("ts").alias("_t"))
    more = end.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(ahead))).alias("_k"), "_i", "_t").select(*keys, (F.col("_i") + F.col("_k")).alias("idx"), F.timestamp_add("MINUTE", F.col("_k") * 30, F.col("_t")).alias("ts"))
    rows = series.select(*keys, "idx", "ts").unionByName(more).withColumn("local", fn.to_local("ts")).withColumn("day", F.to_date("local"))
    rows = rows.join(F.broadcast(holidays.select("day", F.lit(1.0).alias("holiday")).distinct()), "day", "left")
    return rows.select(*keys, "idx", *(make().alias(name) for name, make in CALENDAR.items()))


def trailing(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """What is known at each index: the value, those before, WINDOWS of the last day and week, change on the day before."""
    keys, a, out = list(keys), F.col("actual"), series
    for length in dict.fromkeys(n for n, _, _ in WINDOWS.values()):
        out = ops.rolling(out, keys, "idx", length - 1, 0, {name: of(a) for name, (n, of, _) in WINDOWS.items() if n == length})
    for name, steps in {**STEPS_BACK, "day_before": DAY}.items():
        out = ops.gather(out, series, keys, F.col("idx") - steps, "actual", name)
    return out.select(*keys, "idx", a.alias("last"), *STEPS_BACK, *WINDOWS, (a - F.col("day_before")).alias("change_24h"))


def slot_profiles(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of up to seven values a day apart, ending at each index; windows over chunks of days with the six days before."""
    rows = series.select(*keys, "idx", "actual", (F.col("idx") % DAY).alias("place"), F.floor(F.col("idx") / DAY).alias("day"))
    out = ops.rolling(rows, [*keys, "place"], "day", 6, 0, {"slot_profile": F.avg("actual")}, chunk=512)
    return out.select(*keys, "idx", F.col("actual").alias("latest_slot"), "slot_profile")


def features(series: DataFrame, cal: DataFrame, origins: DataFrame, horizons: DataFrame | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """FEATURES for each (origin, horizon) of each series, with target, actual and the source's own forecast where they are known.

    They depend on rows up to the origin only, so one table of them serves every fit and forecast that starts from these origins.
    Tables of a row an index are joined by merging, so that none is broadcast from the driver.
    """
    keys = list(keys)
    horizons = origins.sparkSession.range(1, AHEAD + 1).select(F.col("id").alias("horizon")) if horizons is None else horizons
    pairs = origins.select(*keys, F.col("idx").alias("origin")).crossJoin(F.broadcast(horizons)).withColumn("target", F.col("origin") + F.col("horizon"))
    at_origin = trailing(series, keys).withColumnRenamed("idx", "origin")
    at_target = cal.withColumnRenamed("idx", "target")
    value = series.select(*keys, F.col("idx").alias("target"), "actual", F.col("forecast").alias("api_forecast"))
    at_target = at_target.join(value.hint("merge"), [*keys, "target"], "left")
    for name, weeks in WEEKS_BACK.items():
        at_target = at_target.join(series.select(*keys, (F.col("idx") + weeks * WEEK).alias("target"), F.col("actual").alias(name)).hint("merge"), [*keys, "target"], "left")
    latest = slot_profiles(series, keys).withColumnRenamed("idx", "latest")
    rows = pairs.join(at_origin.hint("merge"), [*keys, "origin"]).join(at_target.hint("merge"), [*keys, "target"])
    rows = rows.withColumn("latest", F.col("target") - fn.last_known_offset(F.col("horizon"))).join(latest.hint("merge"), [*keys, "latest"], "left")
    rows = rows.withColumn("horizon", F.col("horizon").cast("double")).withColumns({f"{n}_rel": F.col(n) - F.col("last") for n in RELATIVE})
    return rows.select(*keys, "origin", "target", *FEATURES, "actual", "api_forecast")


def daily_origins(series: DataFrame, days: int = 365, hour: int = 0, retrain: int = 28, pinned: str | None = None, least: int = 0, keys: Sequence[str] = ()) -> DataFrame:
    """(idx, issue, fold) of each series: the last known index of each daily issue whose 48 hours are observed; fold counts blocks of `retrain` issues.

    Only a series' last `days` issues, from index `least` on, are tested.
    """
    keys = list(keys)
    known = series.groupBy(*keys).agg(F.max(F.when(F.col("actual").isNotNull(), F.col("idx"))).alias("last"), F.min("ts").alias("start"))
    first = F.date_trunc("day", F.col("start")).cast("timestamp_ntz") + F.expr(f"INTERVAL {24 + hour} HOURS")
    rows = _beside(series.select(*keys, "idx", "ts"), known, keys).withColumn("issue", F.col("ts") + F.expr("INTERVAL 30 MINUTES"))
    rows = rows.filter((F.col("issue") >= first) & (F.hour("issue") == hour) & (F.minute("issue") == 0) & (F.col("idx") <= F.col("last") - AHEAD))
    if pinned:
        wanted = F.lit(pinned).cast("timestamp_ntz")
        rows = rows.filter(F.col("issue") <= wanted)
        if rows.agg(F.max("issue") < wanted - F.expr("INTERVAL 1 DAY") + F.expr("INTERVAL 1 SECOND")).first()[0] is not False:
            raise ValueError(f"no complete 48-hour test for a forecast issued at {pinned}")
    rows = rows.filter(F.col("idx") >= least)
    if not keys:
        rows = rows.orderBy(F.desc("idx")).limit(days)
    from_end = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("idx")))  # a row a day
    rows = rows.withColumn("from_end", from_end).filter(F.col("from_end") <= days)
    tested = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("tested"))
    return _beside(rows, tested, keys).select(*keys, "idx", "issue", F.floor((F.col("tested") - F.col("from_end")) / retrain).cast("int").alias("fold"))


def cutoffs(origins: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, fold, cutoff): the last index that a fold's model may know, that of the fold's first issue."""
    return origins.groupBy(*keys, "fold").agg(F.min("idx").alias("cutoff"))


def training_origins(series: DataFrame, cutoff: int | DataFrame, s: Settings = Settings(), keys: Sequence[str] = ()) -> DataFrame:
    """Every origin_step-th index back from cutoff - 96, at most train_days old, with two weeks before it and a known value.

    cutoff: one index, or a table (keys, cutoff, and what else tells fits apart), whose other columns the origins then have as well.
    """
    rows = series.filter(F.col("actual").isNotNull()).select(*keys, "idx")
    rows = rows.withColumn("cutoff", F.lit(cutoff).cast("long")) if isinstance(cutoff, int) else _beside(rows, cutoff, keys)
    last = F.col("cutoff") - AHEAD
    first = F.greatest(F.lit(2 * WEEK), F.col("cutoff") - s.train_days * DAY)
    rows = rows.filter((F.col("idx") <= last) & (F.col("idx") >= first) & ((last - F.col("idx")) % s.origin_step == 0))
    return rows.drop("cutoff") if isinstance(cutoff, int) else rows


def training_rows(series: DataFrame, cal: DataFrame, cutoff: int | DataFrame, s: Settings = Settings(), keys: Sequence[str] = ()) -> DataFrame:
    """Features with the change to predict, a weight that gives each horizon the same say, and whether the row calibrates."""
    origins = training_origins(series, cutoff, s, keys)
    rows = features(series, cal, origins.select(*keys, "idx").distinct(), keys=keys)
    return weighted(rows, origins, cutoff, s, keys)


def weighted(rows: DataFrame, origins: DataFrame, cutoff: int | DataFrame, s: Settings = Settings(), keys: Sequence[str] = ()) -> DataFrame:
    """Feature rows of the training origins of one or many fits, as training_rows has them; a row stands once for each fit that uses it."""
    keys = list(keys)
    fits = [c for c in origins.columns if c not in ("idx", "cutoff")]  # what tells fits apart
    rows = rows.join(origins.withColumnRenamed("idx", "origin"), [*keys, "origin"])
    rows = rows.withColumn("cutoff", F.lit(cutoff)) if isinstance(cutoff, int) else rows
    rows = rows.withColumn("change", F.col("actual") - F.col("last")).filter("change is not null")
    spread = rows.groupBy(*fits, "horizon").agg(F.var_pop("change").alias("v"), F.count(F.lit(1)).alias("n")).withColumn("w", F.when(F.col("v") > 0, 1 / F.col("v")).otherwise(1.0))
    scale = spread.groupBy(*fits).agg((F.sum(F.col("w") * F.col("n")) / F.sum("n")).alias("mean_w"))
    spread = _beside(spread, scale, fits).select(*fits, "horizon", (F.col("w") / F.col("mean_w")).alias("weight"))
    rows = rows.join(spread if fits else F.broadcast(spread), [*fits, "horizon"])
    return rows.withColumn("calibrates", F.col("origin") + AHEAD > F.col("cutoff") - s.calibration_days * DAY).drop("cutoff")


def conformal(scored: DataFrame, coverage: float = 0.8) -> DataFrame:
    """(lead_band, widening, n): per quarter-day of lead the ceil((n + 1) * coverage) / n quantile of max(lo - y, y - hi), interpolated."""
    s = written(scored.select(fn.lead_band(F.col("horizon")).alias("lead_band"), F.greatest(F.col("lo") - F.col("y"), F.col("y") - F.col("hi")).alias("score")))  # read several times
    level = F.least(F.lit(1.0), F.ceil((F.col("n") + 1) * coverage) / F.col("n"))
    return percentiles(s, ["lead_band"], "score", {"widening": level}).select("lead_band", "widening", "n")


class Forecaster:
    """Boosted trees for the change since the last value: a point model on squared error and two bounds on pinball loss, widened conformally.

    The point model is fitted on every row. The bounds are fitted on the rows before the calibration days, and what they miss on these
    widens them by lead band.
    """

    def __init__(self, settings: Settings = Settings()):
        self.s = settings

    def _prepared(self):
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler

        plain = [c for c in FEATURES if c != "weekday"]
        filled = [f"{c}_f" for c in plain]
        gaps = [f"{c}_gap" for c in RELATIVE]
        return Pipeline(stages=[
            Imputer(inputCols=plain, outputCols=filled),
            StringIndexer(inputCol="weekday", outputCol="weekday_c", stringOrderType="alphabetAsc", handleInvalid="keep"),  # a category to the trees
            VectorAssembler(inputCols=[*filled, "weekday_c", *gaps], outputCol="x"),
        ])

    def _point(self):
        from pyspark.ml.regression import GBTRegressor

        return GBTRegressor(featuresCol="x", labelCol="change", weightCol="weight", predictionCol="moved", maxIter=self.s.trees, maxDepth=self.s.depth, stepSize=self.s.rate, minInstancesPerNode=50, seed=7)

    @staticmethod
    def _flags(rows: DataFrame) -> DataFrame:
        return rows.withColumns({f"{c}_gap": F.col(c).isNull().cast("double") for c in RELATIVE})

    def fit(self, training: DataFrame) -> Forecaster:
        """From training_rows of one series and cutoff."""
        s = self.s
        rows = self._flags(training).persist()
        counts = rows.agg(F.count(F.lit(1)), F.sum(F.col("calibrates").cast("long"))).first()
        try:
            if counts[0] < s.least_rows:
                raise TooLittleHistory(f"only {counts[0]} usable training rows")
            split = (counts[1] or 0) >= s.least_calibration and counts[0] - counts[1] >= s.least_rows
            self.prepare = self._prepared().fit(rows)
            ready = self.prepare.transform(rows).select("horizon", "x", "change", "weight", "calibrates").repartition(-(-counts[0] // ROWS_A_TASK)).persist()
            self.model = self._point().fit(ready)
            self.bounds = PinballTrees(((1 - s.coverage) / 2, (1 + s.coverage) / 2), s.bound_trees, s.bound_rate, s.depth).fit(ready.filter(~F.col("calibrates")) if split else ready, "x", "change", "weight")
            held = self.bounds.predict(ready.filter("calibrates") if split else ready, "x", ("lo", "hi"))
            self.widening = conformal(held.select("horizon", F.col("change").alias("y"), "lo", "hi"), s.coverage).select("lead_band", "widening").collect()  # a row a lead band
            ready.unpersist()
        finally:
            rows.unpersist()
        return self

    def predict(self, rows: DataFrame) -> DataFrame:
        """Adds model, model_p10 and model_p90 to feature rows, with p10 <= model <= p90."""
        ready = self.prepare.transform(self._flags(rows).withColumn("weight", F.lit(1.0)))
        out = self.bounds.predict(self.model.transform(ready), "x", ("lo", "hi")).withColumn("lead_band", fn.lead_band(F.col("horizon")))
        widen = F.coalesce(*(F.when(F.col("lead_band") == r.lead_band, F.lit(r.widening)) for r in self.widening), F.lit(0.0)) if self.widening else F.lit(0.0)
        point = F.col("last") + F.col("moved")
        low, high = F.col("last") + F.col("lo") - widen, F.col("last") + F.col("hi") + widen
        return out.withColumns({"model": point, "model_p10": F.least(low, point), "model_p90": F.greatest(high, point)}).select(*rows.columns, "model", "model_p10", "model_p90")


def baselines(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"persistence": F.col("last"), "naive_yesterday": F.col("latest_slot"), "naive_last_week": F.col("back_1w")})


def stand_in(rows: DataFrame) -> DataFrame:
    """A model without fitting, for scores that another engine can follow: the slot profile, plus and minus the day's deviation."""
    return rows.withColumns({"model": F.col("slot_profile"), "model_p10": F.col("slot_profile") - F.col("std_24h"), "model_p90": F.col("slot_profile") + F.col("std_24h")})


def prediction_table(rows: DataFrame, origins: DataFrame, series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    issues = origins.select(*keys, F.col("idx").alias("origin"), "issue", "fold")
    times = series.select(*keys, F.col("idx").alias("target"), F.col("ts").alias("target_ts"))
    out = baselines(rows).join(issues if keys else F.broadcast(issues), [*keys, "origin"]).join(times.hint("merge"), [*keys, "target"])
    return out.select(*keys, "issue", "target_ts", F.col("horizon").cast("int").alias("horizon"), "actual", *METHODS, "model_p10", "model_p90", "fold")


def common(predictions: DataFrame) -> DataFrame:
    return ops.complete(predictions, ["actual", *METHODS, "model_p10", "model_p90"])


def _banded(rows: DataFrame, bands) -> DataFrame:
    picked = F.array_compact(F.array(*(F.when(F.col("horizon").between(a, b), F.lit(n)) for n, a, b in bands)))
    return rows.withColumn("band", F.explode(picked))


def by_method(predictions: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Metrics of each method in each horizon band, of each series, over pairs that every method has."""
    long = common(predictions).unpivot([*keys, "issue", "horizon", "actual"], list(METHODS), "method", "value").withColumn("error", F.col("value") - F.col("actual"))
    return _banded(long, BANDS).groupBy(*keys, "band", "method").agg(*error_metrics("error", "actual"))


INSIDE = "actual between model_p10 and model_p90"


def interval_coverage(predictions: DataFrame) -> DataFrame:
    return _banded(common(predictions), BANDS).groupBy("band").agg(F.count(F.lit(1)).alias("n"), (100 * F.avg(F.expr(INSIDE).cast("double"))).alias("coverage_pct"), F.avg(F.col("model_p90") - F.col("model_p10")).alias("mean_width"))


def _maes() -> list:
    return [F.avg(F.abs(F.col(m) - F.col("actual"))).alias(f"mae_{m}") for m in METHODS]


def by_lead(predictions: DataFrame) -> DataFrame:
    return _banded(common(predictions), LEADS).groupBy("band").agg(F.count(F.lit(1)).alias("n"), *_maes(), (100 * F.avg(F.expr(INSIDE).cast("double"))).alias("coverage_pct"))


def by_month(predictions: DataFrame) -> DataFrame:
    return common(predictions).filter(F.col("horizon") > DAY).groupBy(F.date_format("target_ts", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("n"), *_maes(), (100 * F.avg(F.expr(INSIDE).cast("double"))).alias("coverage_pct"))


def by_horizon(predictions: DataFrame) -> DataFrame:
    return common(predictions).groupBy((F.col("horizon") / 2).alias("hours_ahead")).agg(F.count(F.lit(1)).alias("n"), *_maes())


def win_rates(predictions: DataFrame) -> DataFrame:
    daily = common(predictions).filter(F.col("horizon") > DAY).groupBy("issue").agg(*_maes())
    long = daily.unpivot(["issue", "mae_model"], [f"mae_{m}" for m in METHODS[1:]], "other", "mae")
    return long.groupBy(F.regexp_replace("other", "^mae_", "").alias("compared_with")).agg(F.count(F.lit(1)).alias("days"), F.sum((F.col("mae_model") < F.col("mae")).cast("long")).alias("better_days"), (100 * F.avg((F.col("mae_model") < F.col("mae")).cast("double"))).alias("better_pct"))


def first_cutoff(s: Settings) -> int:
    """The least index before which a gap-free series has enough training rows."""
    return 2 * WEEK + AHEAD + s.origin_step * -(-s.least_rows // AHEAD)


def backtest(w: Warehouse, s: Settings = Settings(), days: int = 365, retrain: int = 28, at_once: int = 4) -> DataFrame:
    """Predictions of the last `days` daily origins before which there is enough to train on, each fold's model fitted on data before its first.

    Features are made once, for the training origins of all folds and the tested ones together; a fold reads its own origins from
    that table. Up to `at_once` folds are fitted at a time, each in a scheduler pool of its own.
    """
    series = national_series(w).persist()
    cal = calendar(series, w.raw.holidays).persist()
    origins = daily_origins(series, days, 0, retrain, least=first_cutoff(s)).persist()
    folds = cutoffs(origins).persist()
    train = training_origins(series, folds, s).persist()
    made = written(features(series, cal, train.select("idx").unionByName(origins.select("idx")).distinct()))
    spark = made.sparkSession

    def one(row) -> DataFrame:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fold-{row.fold}")
        mine = train.filter(F.col("fold") == row.fold).select("idx")
        model = Forecaster(s).fit(weighted(made, mine, row.cutoff, s))
        tested = origins.filter(F.col("fold") == row.fold).select(F.col("idx").alias("origin"))
        part = model.predict(made.join(F.broadcast(tested), "origin", "left_semi"))
        return written(prediction_table(part, origins, series))

    with ThreadPoolExecutor(at_once) as pool:
        parts = list(pool.map(inheritable_thread_target(spark)(one), folds.orderBy("fold").collect()))  # one fit a fold
    out = prediction_table(stand_in(made), origins, series).limit(0) if not parts else reduce(DataFrame.unionByName, parts)
    for kept in (train, folds, origins, cal, series):
        kept.unpersist()
    return out


def validation_run(w: Warehouse, until: str, path: str, predict, settings: str) -> None:
    """A backtest as it would have been at a time: the series before it, predictions and their scores stored with cutoff and settings.

    predict(series, calendar, origins) -> feature rows with model, model_p10 and model_p90.
    """
    series = before(national_series(w), until).persist()
    cal = calendar(series, w.raw.holidays)
    origins = daily_origins(series).persist()
    predictions = prediction_table(predict(series, cal, origins), origins, series).persist()
    write_run(predictions, {"by_method": by_method(predictions), "coverage": interval_coverage(predictions)}, path, until, settings)
    for kept in (predictions, origins, series):
        kept.unpersist()


def next_forecast(w: Warehouse, s: Settings = Settings()) -> DataFrame:
    """The 48 hours after the last actual."""
    series = national_series(w).persist()
    cal = calendar(series, w.raw.holidays).persist()
    last = series.filter("actual is not null").agg(F.max("idx")).first()[0]
    if last is None:
        raise TooLittleHistory("no value in the series")
    origin = series.filter(F.col("idx") == last).select("idx")
    model = Forecaster(s).fit(training_rows(series, cal, last, s))
    return model.predict(features(series, cal, origin)).select("origin", F.col("horizon").cast("int").alias("horizon"), "model", "model_p10", "model_p90")
