"""Analytical questions over the warehouse, and the measures of its semantic layer."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import series as ops
from ..operators.quantiles import grouped
from .warehouse import Warehouse, one

YEARS = (1995, 1996, 1998, 2000)


def coverage(w: Warehouse) -> DataFrame:
    n = w.national
    flag = [F.sum(F.col(c).cast("long")).alias(a) for c, a in (("is_missing", "missing"), ("is_actual_implausible", "implausible_actuals"), ("is_forecast_implausible", "implausible_forecasts"))]
    stamp = "yyyy-MM-dd HH:mm"
    return n.agg(F.date_format(F.min("ts"), stamp).alias("first_period"), F.date_format(F.max(F.when(F.col("actual").isNotNull(), F.col("ts"))), stamp).alias("last_actual"), F.count(F.lit(1)).alias("half_hours"), *flag)


def spread(w: Warehouse) -> DataFrame:
    return grouped(w._known, [], [], "actual", {"p10": 0.1, "p90": 0.9})


def best_and_worst_slots(w: Warehouse, best: int = 5, worst: int = 46) -> DataFrame:
    return w.start_slots.filter((F.col("rank_lowest") <= best) | (F.col("rank_lowest") >= worst))


def week_extremes(w: Warehouse, best: int = 5, worst: int = 3) -> DataFrame:
    low = w.week_slots.filter(F.col("rank_lowest") <= best).withColumn("side", F.lit("best"))
    high = w.week_slots.orderBy(F.desc("rank_lowest"), "weekday", "time_key").limit(worst).withColumn("side", F.lit("worst"))
    return low.unionByName(high)


def modal_starts(w: Warehouse) -> DataFrame:
    """The start that the profile rule chose most often in each month, with the month's days."""
    chosen = w.complete_days.join(F.broadcast(w.dim_time.select(F.col("time_key").alias("profile_time_key"), "label")), "profile_time_key")
    n = chosen.groupBy(F.date_format("day", "yyyy-MM").alias("year_month"), "label").agg(F.count(F.lit(1)).alias("days"))
    month = Window.partitionBy("year_month")
    ranked = n.withColumns({"month_days": F.sum("days").over(month), "k": F.row_number().over(month.orderBy(F.desc("days"), "label"))})
    return ranked.filter("k = 1").drop("k")


def modal_start(w: Warehouse) -> DataFrame:
    chosen = w.complete_days.join(F.broadcast(w.dim_time.select(F.col("time_key").alias("profile_time_key"), "label")), "profile_time_key")
    return chosen.groupBy("label").agg(F.count(F.lit(1)).alias("days")).orderBy(F.desc("days"), "label").limit(1)


def excluded_days(w: Warehouse) -> DataFrame:
    """Days of the window that the comparison lacks, with the half-hours (up to 04:00 the next day) that explain it.

    A range join would be a nested loop; each excluded day meets its own and the next local date by equality instead.
    """
    days = w.report_window.select(F.explode(F.sequence("start_date", "end_date", F.expr("INTERVAL 1 DAY"))).alias("day"))
    out = days.join(F.broadcast(w.complete_days.select("day")), "day", "left_anti")
    reach = out.withColumn("local_date", F.explode(F.array(F.col("day"), F.date_add("day", 1))))
    faults = w.half_hours.filter("is_missing or is_actual_missing or is_forecast_implausible")
    faults = faults.join(F.broadcast(reach), "local_date").filter(F.col("local_ts") < F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 28 HOURS"))
    reason = F.when(F.col("is_missing"), "not served").when(F.col("is_actual_implausible"), "implausible actual").when(F.col("is_forecast_implausible"), "implausible forecast").otherwise("no actual")
    return out.join(faults.select("day", "ts", reason.alias("reason")), "day", "left")


def comparison_listing(w: Warehouse) -> DataFrame:
    return w.country_comparison.withColumn("wind_solar_share", F.col("wind_share") + F.col("solar_share")).orderBy("intensity")


def trend_pivot(w: Warehouse, years=YEARS) -> DataFrame:
    rows = w.country_trend.filter(F.col("year").isin(*years))
    out = rows.groupBy("name").pivot("year", list(years)).agg(F.any_value("intensity"))
    return out.select("name", *(F.col(str(y)).alias(f"y{y}") for y in years))


def country_history(w: Warehouse, country: str = "C00", since: int = 1996) -> DataFrame:
    return w.country_intensity.filter((F.col("country") == country) & (F.col("year") >= since)).orderBy("year")


def annual_coverage(w: Warehouse) -> DataFrame:
    return w.annual.withColumn("coverage_pct", F.lit(100.0) * F.col("with_actual") / (48 * F.when(F.col("year") % 4 == 0, 366).otherwise(365)))


def season_extremes(w: Warehouse) -> DataFrame:
    m = F.col("mean_actual")
    return w.seasonal_profile.groupBy("season").agg(
        ops.pick_lowest("label", "mean_actual").alias("lowest"), F.min(m).alias("lowest_mean"), F.min_by("label", F.struct((-m).alias("v"), F.col("label"))).alias("highest"), F.max(m).alias("highest_mean")
    )


def headline(w: Warehouse) -> DataFrame:
    """One row of ratios between rules: the oracle's saving, the share of it that each rule captures, kilograms saved."""
    s = w.savings

    def of(strategy, column):
        return F.max(F.when(F.col("strategy") == strategy, F.col(column)))

    row = s.agg(of("oracle", "saving_0900").alias("oracle"), of("profile_guided", "saving_0900").alias("profile"), of("forecast_guided", "saving_0900").alias("forecast"), of("fixed_0900", "kg_per_run").alias("kg_base"), of("profile_guided", "kg_per_run").alias("kg_profile"))
    slots = w.start_slots.agg(F.min("mean_job").alias("best"), F.max("mean_job").alias("worst"))
    kg = F.col("kg_base") - F.col("kg_profile")
    return row.crossJoin(one(slots)).select(
        (F.lit(100.0) * F.try_divide("profile", "oracle")).alias("profile_share_pct"), (F.lit(100.0) * F.try_divide("forecast", "oracle")).alias("forecast_share_pct"),
        (F.lit(100.0) * (F.col("worst") - F.col("best")) / F.col("best")).alias("worst_over_best_pct"), kg.alias("kg_saved"), (kg * 365 / 1000).alias("tonnes_a_year"),
    )


def kpis(w: Warehouse) -> DataFrame:
    """One row for a dashboard's head; a figure that can't be had is null."""
    n = w.national
    last = n.filter("actual is not null").agg(F.max("ts").alias("last_ts"))
    week = n.crossJoin(one(last)).filter(F.col("ts") > F.col("last_ts") - F.expr("INTERVAL 7 DAYS")).agg(F.avg("actual").alias("week_mean"))
    whole = w._known.agg(F.avg("actual").alias("window_mean"))
    best = w.start_slots.orderBy("rank_lowest", "time_key").limit(1).select(F.col("label").alias("best_start"))
    saving = w.savings.filter("strategy = 'profile_guided'").select("saving_0900_pct")
    mae = w.forecast_accuracy.filter("scope = 'report_window'").select("mae")
    return reduce(lambda a, b: a.join(one(b), F.lit(True), "left"), (whole, best, saving, mae), week)


def last_two_days(w: Warehouse) -> DataFrame:
    n = w.national
    last = n.filter("actual is not null").agg(F.max("ts").alias("last_ts"))
    return n.crossJoin(one(last)).filter(F.col("ts") > F.col("last_ts") - F.expr("INTERVAL 2 DAYS")).drop("last_ts")


def latest_snapshot(w: Warehouse) -> DataFrame:
    newest = w.snapshots.agg(F.max("issued").alias("newest"))
    return w.snapshots.join(F.broadcast(newest), F.col("issued") == F.col("newest")).filter("lead_minutes >= 0").drop("newest")


def export_tail(w: Warehouse, days: int = 365) -> DataFrame:
    end = w.national.agg(F.max("ts").alias("end"))
    rows = w.national.crossJoin(one(end)).filter(F.col("ts") >= F.col("end") - F.expr(f"INTERVAL {days} DAYS"))
    return rows.select(F.date_format("ts", "yyyy-MM-dd HH:mm").alias("moment"), "forecast", "actual", F.round("wind_pct", 3).alias("wind_pct"), F.round("gas_pct", 3).alias("gas_pct"))


def daily_rollup(w: Warehouse) -> DataFrame:
    return w._dated(w.national).groupBy("day").agg(F.avg("actual").alias("mean_actual"), F.min("actual").alias("min_actual"), F.max("actual").alias("max_actual"), F.avg(F.abs("error")).alias("mae"), F.avg("low_carbon_pct").alias("low_carbon_pct"), F.count("actual").alias("periods"))


def daily_mix(w: Warehouse) -> DataFrame:
    return w._dated(w.mix).groupBy("day", "fuel").agg(F.avg("share").alias("mean_share"), F.count(F.lit(1)).alias("periods"))


def daily_regional(w: Warehouse) -> DataFrame:
    return w._dated(w.regional).groupBy("day", "region_id").agg(F.avg("forecast").alias("mean_forecast"), F.count("forecast").alias("periods"))


def week_matrix(w: Warehouse) -> DataFrame:
    """Seven rows by 48 columns of mean intensity."""
    out = w.weekly_profile.groupBy("weekday").pivot("time_key", list(range(48))).agg(F.first("mean_actual"))
    return out.select("weekday", *(F.col(str(k)).alias(f"s{k:02d}") for k in range(48)))


def measures(w: Warehouse) -> DataFrame:
    n = w._dated(w.national).join(F.broadcast(w.dim_time.select("time_key", "label", "is_evening_peak")), "time_key")
    a, e = F.col("actual"), F.col("error")
    slots = n.groupBy("label").agg(F.avg("actual").alias("m")).agg(ops.pick_lowest("label", "m").alias("lowest_half_hour"))
    row = n.agg(F.avg(a).alias("mean_actual"), F.avg(F.abs(e)).alias("mae"), (100 * F.avg(F.when(a > 0, F.abs(e) / a))).alias("mape_pct"), F.avg("low_carbon_pct").alias("low_carbon_pct"), (F.lit(100.0) * F.avg(F.when(F.col("is_evening_peak"), a)) / F.avg(a) - 100).alias("evening_premium_pct"))
    return row.crossJoin(one(slots))


def same_period_last_year(w: Warehouse) -> DataFrame:
    """Count-weighted monthly mean of a daily series, and its change on the month a year before."""
    d = w.raw.daily_orders.withColumn("month", F.trunc("day", "month")).groupBy("month").agg((F.sum(F.col("value") * F.col("orders")) / F.sum("orders")).alias("mean_value"))
    past = d.select(F.add_months("month", 12).alias("month"), F.col("mean_value").alias("before"))
    return d.join(past, "month", "left").withColumn("change_pct", F.lit(100.0) * (F.col("mean_value") - F.col("before")) / F.col("before"))


def weighted_shares(w: Warehouse) -> DataFrame:
    m = w.regional_mix_daily
    return m.groupBy("fuel").agg((F.sum(F.col("mean_share") * F.col("periods")) / F.sum("periods")).alias("weighted_share"), F.sum("periods").alias("periods"))


def weighted_intensity(w: Warehouse) -> DataFrame:
    """Generation-weighted intensity of each group and year, its ratio to the home group, and the change since the base year."""
    t = w.country_trend.filter(~F.col("is_aggregate"))
    g = t.groupBy("peer_group", "year").agg((F.lit(1000.0) * F.sum("emissions") / F.sum("generation")).alias("intensity"))
    home = g.filter("peer_group = 'UK'").select("year", F.col("intensity").alias("home"))
    base = g.filter(F.col("year") == w.p.base_year).select("peer_group", F.col("intensity").alias("base"))
    out = g.join(F.broadcast(home), "year", "left").join(F.broadcast(base), "peer_group", "left")
    return out.withColumns({"ratio_to_home": F.col("intensity") / F.col("home"), "change_pct": F.lit(100.0) * (F.col("intensity") - F.col("base")) / F.col("base")})
