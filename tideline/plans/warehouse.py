"""The star schema and its reports, as lazy DataFrames built from one another."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import timefn as fn
from ..operators import series as ops
from ..operators.quantiles import grouped
from ..sources.bound import FUEL_NAMES, Bound

SOURCES = ("Gas", "Coal", "Nuclear", "Solar", "Wind")
STRATEGIES = {
    "fixed_0000": "Fixed start 00:00",
    "fixed_0900": "Fixed start 09:00",
    "fixed_1700": "Fixed start 17:00",
    "any_start": "Mean of all starts",
    "profile_guided": "Trailing profile",
    "forecast_guided": "Source forecast",
    "oracle": "Perfect foresight",
}


@dataclass(frozen=True)
class Params:
    """Settings of the warehouse; the defaults are those of the full-size feed."""

    low: int = 10
    high: int = 700
    job_hours: float = 4
    job_kw: float = 100
    lookback_days: int = 28
    complete_starts: int = 46
    window: tuple[str, str] | None = None
    group_members: int = 6
    first_year: int = 2000
    base_year: int = 2015
    home: str = "GBR"
    union: str = "EU27"
    world: str = "WLD"

    @property
    def periods(self) -> int:
        return int(self.job_hours * 2)

    @property
    def least_days(self) -> int:
        return round(self.lookback_days * 0.7)


def error_metrics(error, actual, forecast=None) -> list:
    """Count, MAE, RMSE, MAPE (positive actuals only), bias, shares within 10 and 25, mean actual."""
    error, actual = F.col(error), F.col(actual)
    return [
        F.count(F.lit(1)).alias("periods"), F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error * F.lit(1.0))).alias("rmse"),
        (100 * F.avg(F.when(actual > 0, F.abs(error) / actual))).alias("mape_pct"), F.avg(error).alias("bias"),
        (100 * F.avg((F.abs(error) <= 10).cast("double"))).alias("within_10_pct"), (100 * F.avg((F.abs(error) <= 25).cast("double"))).alias("within_25_pct"),
        F.avg(actual).alias("mean_actual"),
    ]


def one(df: DataFrame) -> DataFrame:
    """A table of one row, or of bounded size, for a broadcast cross join."""
    return F.broadcast(df)


class Warehouse:
    """Models that several reports read (spine, facts, job windows, country years) are kept once computed; see release()."""

    def __init__(self, raw: Bound, params: Params = Params()):
        self.raw, self.p = raw, params
        self._kept: list[DataFrame] = []

    def _keep(self, df: DataFrame) -> DataFrame:
        """Spills to executors' disks, and is computed again where an executor is lost."""
        self._kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return self._kept[-1]

    def release(self) -> None:
        while self._kept:
            self._kept.pop().unpersist()

    # ---- spine and intermediates ----

    @cached_property
    def half_hours(self) -> DataFrame:
        """The gap-free national spine with local keys, cleaned values and four flags."""
        p = self.p
        rows = ops.on_spine(self.raw.national, [], "ts")
        forecast, bad_forecast = ops.in_range("forecast", p.low, p.high)
        actual, bad_actual = ops.in_range("actual", p.low, p.high)
        local = rows.withColumn("local_ts", fn.to_local("ts"))
        out = local.select(
            "ts", (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_ts"), "local_ts", F.to_date("local_ts").alias("local_date"),
            fn.date_key("local_ts").alias("date_key"), fn.slot("local_ts").alias("time_key"), forecast.alias("forecast"), actual.alias("actual"), "band",
            (~F.col("seen")).alias("is_missing"), bad_forecast.alias("is_forecast_implausible"), bad_actual.alias("is_actual_implausible"),
            (F.col("actual").isNull() | bad_actual).alias("is_actual_missing"),
        )
        return self._keep(out)

    @cached_property
    def mix_wide(self) -> DataFrame:
        mix = self.raw.mix.join(F.broadcast(self.raw.fuels), "fuel")
        share = F.col("share")
        by_fuel = [F.sum(F.when(F.col("fuel") == f, share)).alias(f"{f}_pct") for f in FUEL_NAMES]
        by_class = [F.coalesce(F.sum(F.when(F.col(c), share)), F.lit(0.0)).alias(n) for c, n in (("is_fossil", "fossil_pct"), ("is_renewable", "renewable_pct"), ("is_low_carbon", "low_carbon_pct"))]
        return mix.groupBy("ts").agg(*by_fuel, *by_class, F.sum(share).alias("total_pct"))

    @cached_property
    def regional_half_hours(self) -> DataFrame:
        return self.raw.regional.withColumn("local_ts", fn.to_local("ts"))

    @cached_property
    def job_windows(self) -> DataFrame:
        """Means over a job that starts in each half-hour; only windows with every row and value."""
        k = self.p.periods
        rows = ops.indexed(self.half_hours.select("ts", "local_ts", "local_date", "date_key", "time_key", "forecast", "actual"), [], "ts")
        means = {"job_actual": F.avg("actual"), "n_actual": F.count("actual"), "job_forecast": F.avg("forecast"), "n_forecast": F.count("forecast"), "n": F.count(F.lit(1))}
        out = ops.rolling(rows, [], "idx", 0, k - 1, means)
        whole = out.filter((F.col("n") == k) & (F.col("n_actual") == k) & (F.col("n_forecast") == k))
        return self._keep(whole.select("ts", "local_ts", F.col("local_date").alias("day"), "date_key", "time_key", "job_actual", "job_forecast"))

    @cached_property
    def country_year(self) -> DataFrame:
        rows = self.raw.yearly.join(F.broadcast(self.raw.countries), "area", "left_semi")
        total = F.col("source") == "Total generation"
        cells = [F.max(F.when(total, F.col(c))).alias(c) for c in ("generation", "emissions", "intensity")]
        cells += [F.max(F.when(F.col("source") == s, F.col("share"))).alias(f"{s.lower()}_share") for s in SOURCES]
        wide = rows.groupBy("area", "year").agg(*cells).filter("generation is not null")
        named = wide.join(F.broadcast(self.raw.countries.select("area", "country")), "area").drop("area")
        zeros = {f"{s.lower()}_share": F.coalesce(f"{s.lower()}_share", F.lit(0.0)) for s in SOURCES}
        return self._keep(named.withColumns(zeros).withColumns({"fossil_share": F.col("gas_share") + F.col("coal_share"), "clean_share": F.col("nuclear_share") + F.col("solar_share") + F.col("wind_share")}))

    # ---- dimensions ----

    @cached_property
    def dim_date(self) -> DataFrame:
        span = self.half_hours.agg(F.min("local_date").alias("a"), F.date_add(F.max("local_date"), 2).alias("b")).filter("a is not null")
        days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 DAY"))).alias("day"))
        named = self.raw.holidays.groupBy("day").agg(F.min("name").alias("holiday"))
        weekend = fn.iso_weekday("day") >= 6
        return days.join(F.broadcast(named), "day", "left").select(
            fn.date_key("day").alias("date_key"), "day", F.year("day").alias("year"), F.quarter("day").alias("quarter"), F.month("day").alias("month"),
            F.date_format("day", "MMMM").alias("month_name"), F.date_format("day", "yyyy-MM").alias("year_month"), F.dayofmonth("day").alias("day_of_month"),
            fn.iso_weekday("day").alias("weekday"), F.date_format("day", "EEEE").alias("day_name"), weekend.alias("is_weekend"), F.col("holiday").isNotNull().alias("is_holiday"),
            "holiday", (~weekend & F.col("holiday").isNull()).alias("is_working_day"), fn.season(F.month("day")).alias("season"),
        )

    @cached_property
    def dim_time(self) -> DataFrame:
        s = F.col("id").cast("int")
        part = F.when(s < 14, "Night").when(s < 24, "Morning").when(s < 32, "Afternoon").when(s < 38, "Evening peak").otherwise("Evening")
        return self.raw.spark.range(48).select(s.alias("time_key"), fn.slot_label(s).alias("label"), F.floor(s / 2).cast("int").alias("hour"), ((s % 2) * 30).alias("minute"), part.alias("day_part"), s.between(32, 37).alias("is_evening_peak"))

    @property
    def dim_region(self) -> DataFrame:
        return self.raw.regions

    @property
    def dim_fuel(self) -> DataFrame:
        return self.raw.fuels

    @cached_property
    def dim_country(self) -> DataFrame:
        years = self.country_year.groupBy("country").agg(F.min("year").alias("first_year"), F.max("year").alias("latest_year"))
        return self.raw.countries.join(years, "country", "left")

    # ---- facts ----

    @cached_property
    def national(self) -> DataFrame:
        rows = self.half_hours.join(self.mix_wide.withColumn("_mix", F.lit(True)), "ts", "left")
        return self._keep(rows.withColumns({"error": F.col("forecast") - F.col("actual"), "is_mix_missing": F.col("_mix").isNull()}).drop("_mix"))

    @cached_property
    def mix(self) -> DataFrame:
        return self.raw.mix.join(self.half_hours.select("ts", "date_key", "time_key"), "ts")

    @cached_property
    def regional(self) -> DataFrame:
        return self.regional_half_hours.select("ts", "region_id", fn.date_key("local_ts").alias("date_key"), fn.slot("local_ts").alias("time_key"), "local_ts", "forecast", "band")

    @cached_property
    def regional_mix_daily(self) -> DataFrame:
        return self.raw.regional_mix.groupBy(fn.date_key(fn.to_local("ts")).alias("date_key"), "region_id", "fuel").agg(F.avg("share").alias("mean_share"), F.count(F.lit(1)).alias("periods"))

    @cached_property
    def staged_snapshots(self) -> DataFrame:
        return self.raw.snapshots.withColumn("lead_minutes", fn.minutes_between("issued", "ts"))

    @cached_property
    def snapshots(self) -> DataFrame:
        clean, bad = ops.in_range("forecast", self.p.low, self.p.high)
        rows = self.staged_snapshots.withColumns({"clean": clean, "is_forecast_implausible": bad}).join(self.half_hours.select("ts", "actual"), "ts", "left")
        return rows.select("issued", "ts", "lead_minutes", fn.date_key(fn.to_local("ts")).alias("date_key"), F.col("clean").alias("forecast"), "is_forecast_implausible", "actual", (F.col("clean") - F.col("actual")).alias("error"))

    @cached_property
    def country_electricity(self) -> DataFrame:
        return self.raw.yearly.join(F.broadcast(self.raw.countries.select("area", "country")), "area").drop("area")

    @cached_property
    def country_intensity(self) -> DataFrame:
        before = F.lag("intensity").over(Window.partitionBy("country").orderBy("year"))
        return self.country_year.withColumn("change", F.col("intensity") - before)

    # ---- reports ----

    @cached_property
    def report_window(self) -> DataFrame:
        """One row: the last twelve complete months within the data, an override, or everything if that is empty."""
        known = F.when(~F.col("is_actual_missing"), F.col("local_date"))
        b = self.half_hours.agg(F.min(known).alias("first"), F.max(known).alias("last"))
        full = F.when(F.col("last") == F.last_day("last"), F.col("last")).otherwise(F.date_sub(F.trunc("last", "month"), 1))
        b = b.withColumn("full", full)
        if self.p.window:
            a, z = (F.lit(x).cast("date") for x in self.p.window)
        else:
            a, z = F.greatest("first", F.add_months(F.trunc("full", "month"), -11)), F.col("full")
        b = b.withColumns({"a": a, "z": z})
        ok = F.col("z") >= F.col("a")
        out = b.select(F.when(ok, F.col("a")).otherwise(F.col("first")).alias("start_date"), F.when(ok, F.col("z")).otherwise(F.col("last")).alias("end_date"))
        return out.select("start_date", "end_date", (F.datediff("end_date", "start_date") + 1).alias("days"), F.lit(float(self.p.job_hours)).alias("job_hours"))

    def _within(self, rows: DataFrame, day: str) -> DataFrame:
        w = one(self.report_window.select("start_date", "end_date"))
        return rows.crossJoin(w).filter(F.col(day).between(F.col("start_date"), F.col("end_date"))).drop("start_date", "end_date")

    def _dated(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.dim_date), "date_key")

    @cached_property
    def _known(self) -> DataFrame:
        return self._within(self._dated(self.national), "day").filter("actual is not null")

    @cached_property
    def start_slots(self) -> DataFrame:
        jobs = self._within(self._dated(self.job_windows.drop("day")), "day")
        job = F.col("job_actual")
        by = jobs.groupBy("time_key").agg(F.avg(job).alias("mean_job"), F.avg(F.when(F.col("is_working_day"), job)).alias("working_mean"), F.avg(F.when(~F.col("is_working_day"), job)).alias("non_working_mean"), F.count(F.lit(1)).alias("jobs"))
        return by.join(F.broadcast(self.dim_time.select("time_key", "label")), "time_key").withColumn("rank_lowest", F.rank().over(Window.orderBy("mean_job")))

    @cached_property
    def week_slots(self) -> DataFrame:
        jobs = self._within(self._dated(self.job_windows.drop("day")), "day").join(F.broadcast(self.dim_time.select("time_key", "label")), "time_key")
        by = jobs.groupBy("weekday", "day_name", "time_key", "label").agg(F.avg("job_actual").alias("mean_job"), F.count(F.lit(1)).alias("jobs"))
        return by.withColumn("rank_lowest", F.rank().over(Window.orderBy("mean_job")))

    @cached_property
    def daily_strategies(self) -> DataFrame:
        """Per local day the mean intensity of a job under seven rules for its start; ties go to the earliest slot."""
        p, jobs = self.p, self.job_windows
        daily = jobs.groupBy("day", "time_key").agg(F.avg("job_actual").alias("slot_mean"))
        trailing = Window.partitionBy("time_key").orderBy("n").rangeBetween(-(p.lookback_days + 1), -2)
        profile = daily.withColumn("n", F.datediff("day", F.lit("1970-01-01"))).select("day", "time_key", F.avg("slot_mean").over(trailing).alias("trailing"), F.count("slot_mean").over(trailing).alias("seen"))
        profile = profile.filter((F.col("seen") >= p.least_days) & F.col("trailing").isNotNull())
        choice = profile.groupBy("day").agg(ops.pick_lowest("time_key", "trailing").alias("profile_time_key"))
        realised = choice.join(jobs.select("day", F.col("time_key").alias("profile_time_key"), "job_actual"), ["day", "profile_time_key"]).groupBy("day", "profile_time_key").agg(F.max("job_actual").alias("profile_guided"))

        def fixed(k):
            return F.max(F.when(F.col("time_key") == k, F.col("job_actual")))

        by_forecast = F.when(F.col("job_forecast").isNotNull(), F.struct("job_forecast", "time_key"))
        rules = jobs.groupBy("day", "date_key").agg(
            F.count(F.lit(1)).alias("start_options"), fixed(0).alias("fixed_0000"), fixed(18).alias("fixed_0900"), fixed(34).alias("fixed_1700"), F.avg("job_actual").alias("any_start"),
            F.min_by("job_actual", by_forecast).alias("forecast_guided"), F.min_by("time_key", by_forecast).alias("forecast_time_key"),
            F.min("job_actual").alias("oracle"), ops.pick_lowest("time_key", "job_actual").alias("oracle_time_key"),
        )
        rules = self._within(rules, "day").filter(F.col("start_options") >= p.complete_starts).dropna(subset=["fixed_0000", "fixed_0900", "fixed_1700"])
        return rules.join(realised, "day", "left")

    @cached_property
    def complete_days(self) -> DataFrame:
        return self.daily_strategies.dropna(subset=["profile_guided", "forecast_guided"])

    @cached_property
    def savings(self) -> DataFrame:
        return savings_of(self.complete_days, self.p)

    @cached_property
    def weekly_profile(self) -> DataFrame:
        rows = self._known.join(F.broadcast(self.dim_time.select("time_key", "label")), "time_key")
        return grouped(rows, ["weekday", "day_name", "time_key", "label"], [F.avg("actual").alias("mean_actual"), F.count("actual").alias("periods")], "actual", {"median_actual": 0.5})

    @cached_property
    def monthly(self) -> DataFrame:
        a = F.col("actual")
        return grouped(self._dated(self.national), ["year_month", "year", "month", "season"], [
            F.min("day").alias("month_start"), F.avg(a).alias("mean_actual"), F.min(a).alias("min_actual"), F.max(a).alias("max_actual"),
            *(F.avg(f"{f}_pct").alias(f"mean_{f}_pct") for f in ("wind", "solar", "gas", "low_carbon")), F.count(a).alias("with_actual"), F.count(F.lit(1)).alias("periods"),
            (F.lit(100.0) * F.count(a) / F.count(F.lit(1))).alias("coverage_pct"),
        ], "actual", {"p10_actual": 0.1, "p90_actual": 0.9})

    @cached_property
    def annual(self) -> DataFrame:
        by = self._dated(self.national).groupBy("year").agg(F.avg("actual").alias("mean_actual"), *(F.avg(f"{f}_pct").alias(f"mean_{f}_pct") for f in ("low_carbon", "wind", "gas", "coal")), F.count("actual").alias("with_actual"), F.min("day").alias("first_date"), F.max("day").alias("last_date"))
        return by.withColumn("is_complete", F.col("with_actual") >= 0.99 * 48 * F.when(F.col("year") % 4 == 0, 366).otherwise(365))

    @cached_property
    def seasonal_profile(self) -> DataFrame:
        rows = self._known.join(F.broadcast(self.dim_time.select("time_key", "label")), "time_key")
        return rows.groupBy("season", "time_key", "label").agg(F.avg("actual").alias("mean_actual"), F.avg("solar_pct").alias("mean_solar_pct"), F.avg("wind_pct").alias("mean_wind_pct"), F.count("actual").alias("periods"))

    @cached_property
    def seasonal_summary(self) -> DataFrame:
        daily = self._known.groupBy("season", "day").agg((F.max("actual") - F.min("actual")).alias("day_range")).groupBy("season").agg(F.avg("day_range").alias("mean_daily_range"), F.count("day").alias("days"))
        half = grouped(self._known, ["season"], [F.avg("actual").alias("mean_actual"), *(F.avg(f"{f}_pct").alias(f"mean_{f}_pct") for f in ("wind", "solar", "gas")), F.count("actual").alias("periods")], "actual", {"p10_actual": 0.1, "p90_actual": 0.9})
        return half.join(F.broadcast(daily), "season").withColumn("season_order", fn.season_order("season"))

    @cached_property
    def regional_report(self) -> DataFrame:
        rows = self._within(self._dated(self.regional), "day").filter("forecast is not null")
        f = F.col("forecast")
        seasons = (F.avg(F.when(F.col("season") == s, f)).alias(f"{s.lower()}_mean") for s in ("Winter", "Spring", "Summer", "Autumn"))
        level = grouped(rows, ["region_id"], [F.avg(f).alias("mean_forecast"), *seasons, F.count(F.lit(1)).alias("periods")], "forecast", {"p10_forecast": 0.1, "p90_forecast": 0.9})
        mix = self._within(self._dated(self.regional_mix_daily), "day").join(F.broadcast(self.dim_fuel), "fuel")
        wind = F.col("fuel") == "wind"
        part, n_wind = F.col("mean_share") * F.col("periods"), F.nullif(F.sum(F.when(wind, F.col("periods"))), F.lit(0))
        shares = mix.groupBy("region_id").agg((F.sum(F.when(wind, part)) / n_wind).alias("mean_wind_pct"), (F.sum(F.when(F.col("is_low_carbon"), part)) / n_wind).alias("mean_low_carbon_pct"), (F.sum(F.when(F.col("is_fossil"), part)) / n_wind).alias("mean_fossil_pct"))
        out = level.join(F.broadcast(self.dim_region), "region_id").join(shares, "region_id", "left")
        return out.withColumn("rank_lowest", F.when(~F.col("is_aggregate"), F.rank().over(Window.partitionBy("is_aggregate").orderBy("mean_forecast"))))

    @cached_property
    def forecast_accuracy(self) -> DataFrame:
        """Metrics by year, and within the window by season and overall, in one pass over the pairs."""
        pairs = self._dated(self.national).dropna(subset=["forecast", "actual"]).crossJoin(one(self.report_window.select("start_date", "end_date")))
        inside = F.col("day").between(F.col("start_date"), F.col("end_date"))

        def scope(name, value):
            return F.struct(F.lit(name).alias("scope"), value.alias("scope_value"))

        title = F.concat_ws(" to ", F.date_format("start_date", "yyyy-MM-dd"), F.date_format("end_date", "yyyy-MM-dd"))
        scopes = F.array_compact(F.array(scope("year", F.col("year").cast("string")), F.when(inside, scope("season", F.col("season"))), F.when(inside, scope("report_window", title))))
        return pairs.withColumn("s", F.explode(scopes)).groupBy("s.scope", "s.scope_value").agg(*error_metrics("error", "actual"))

    @cached_property
    def snapshot_accuracy(self) -> DataFrame:
        lead = F.col("lead_minutes")
        band = F.when(lead < 0, "already started").when(lead < 360, "0-6 h").when(lead < 720, "6-12 h").when(lead < 1440, "12-24 h").otherwise("24-48 h")
        rows = self.snapshots.dropna(subset=["actual", "forecast"]).withColumn("lead_band", band)
        return rows.groupBy("lead_band").agg(F.min("lead_minutes").alias("min_lead"), F.countDistinct("issued").alias("snapshots"), *error_metrics("error", "actual")[:5])

    @cached_property
    def country_trend(self) -> DataFrame:
        rows = self.country_intensity.join(F.broadcast(self.dim_country.select("country", "area", "peer_group")), "country").filter(F.col("year") >= self.p.first_year)
        rows = rows.select("country", F.col("area").alias("name"), "peer_group", "year", "generation", "emissions", "intensity")
        group = rows.filter("peer_group = 'GCC'").groupBy("year").agg(F.sum("generation").alias("generation"), F.sum("emissions").alias("emissions"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == self.p.group_members)
        group = group.select(F.lit("GCC").alias("country"), F.lit("GCC (weighted)").alias("name"), F.lit("GCC aggregate").alias("peer_group"), "year", "generation", "emissions", (F.lit(1000.0) * F.col("emissions") / F.col("generation")).alias("intensity"))
        return rows.withColumn("is_aggregate", F.lit(False)).unionByName(group.withColumn("is_aggregate", F.lit(True)))

    @cached_property
    def country_comparison(self) -> DataFrame:
        p, trend = self.p, self.country_trend
        common = trend.filter(F.col("country") != p.world).groupBy("country").agg(F.max("year").alias("y")).agg(F.min("y").alias("year"))
        latest = trend.join(F.broadcast(common), "year")
        reference = latest.agg(F.max(F.when(F.col("country") == p.home, F.col("intensity"))).alias("home"), F.max(F.when(F.col("country") == p.union, F.col("intensity"))).alias("union"))
        base = trend.filter(F.col("year") == p.base_year).select("country", F.col("intensity").alias("base_intensity"))
        shares = self.country_intensity.select("country", "year", "fossil_share", *(f"{s.lower()}_share" for s in SOURCES), "clean_share")
        out = latest.crossJoin(one(reference)).join(base, "country", "left").join(shares, ["country", "year"], "left")
        return out.withColumns({"ratio_to_home": F.col("intensity") / F.col("home"), "ratio_to_union": F.col("intensity") / F.col("union"), "change_pct": F.lit(100.0) * (F.col("intensity") - F.col("base_intensity")) / F.col("base_intensity")}).drop("home", "union")

    @cached_property
    def annual_export(self) -> DataFrame:
        rows = self.country_intensity.join(F.broadcast(self.dim_country.select("country", "area", "peer_group", "latest_year")), "country")
        rows = rows.filter(F.col("peer_group").isin("GCC", "UK", "EU") & (F.col("year") >= self.p.first_year))
        return rows.select("country", F.col("area").alias("name"), "peer_group", "year", F.round("intensity", 1).alias("intensity"), F.round("generation", 2).alias("generation"), F.round("emissions", 3).alias("emissions"), F.lit("CO2-equivalent").alias("basis"), F.lit("CC BY 4.0").alias("licence"), (F.col("year") == F.col("latest_year")).alias("is_latest"))


def savings_of(days: DataFrame, p: Params) -> DataFrame:
    """Mean of each rule over common days, its savings against three fixed starts, and kilograms for one run."""
    names = list(STRATEGIES)
    long = days.select("day", *(F.col(n).cast("double").alias(n) for n in names)).unpivot(["day"], names, "strategy", "value").dropna(subset=["value"])
    mean = long.groupBy("strategy").agg(F.avg("value").alias("mean_job"), F.count(F.lit(1)).alias("days"))
    base = mean.agg(*(F.max(F.when(F.col("strategy") == f"fixed_{k}", F.col("mean_job"))).alias(f"base_{k}") for k in ("0000", "0900", "1700")))
    out = mean.crossJoin(one(base))
    label = F.lit(None)
    for k, v in STRATEGIES.items():
        label = F.when(F.col("strategy") == k, v).otherwise(label)
    for k in ("0000", "0900", "1700"):
        out = out.withColumns({f"saving_{k}": F.col(f"base_{k}") - F.col("mean_job"), f"saving_{k}_pct": F.lit(100.0) * (F.col(f"base_{k}") - F.col("mean_job")) / F.col(f"base_{k}")})
    kg = F.col("mean_job") * p.job_kw * p.job_hours / 1000
    return out.withColumns({"label": label, "sort_order": F.array_position(F.array(*map(F.lit, names)), F.col("strategy")).cast("int"), "job_kw": F.lit(float(p.job_kw)), "job_hours": F.lit(float(p.job_hours)), "kg_per_run": kg}).drop("base_0000", "base_0900", "base_1700")
