"""Names, columns and SQL of the analytical questions and of the data checks."""

from pyspark.sql import functions as F

from ..functions import timefn as fn
from ..operators import intervals, quality
from ..sources import readers, sinks
from ..streaming import feeds
from . import adhoc
from .catalog import add



def _annual_csv(w):
    """The report written as ordered CSV, and read back with the types it was declared with."""
    path = feeds.shared(w.raw.spark)
    table = w.annual_export.select("country", "name", "year", "intensity", "is_latest")
    sinks.write_csv(table, path, ["country", "year"])
    return readers.seed_csv(w.raw.spark, path, "country string, name string, year int, intensity double, is_latest boolean")


add("q01_coverage", "first_period last_actual half_hours:i missing:i implausible_actuals:i implausible_forecasts:i", adhoc.coverage,
    "(SELECT strftime(min(ts), '%Y-%m-%d %H:%M') AS first_period, strftime(max(ts) FILTER (actual IS NOT NULL), '%Y-%m-%d %H:%M') AS last_actual, count(*) AS half_hours, count(*) FILTER (is_missing) AS missing, count(*) FILTER (is_actual_implausible) AS implausible_actuals, count(*) FILTER (is_forecast_implausible) AS implausible_forecasts FROM fn)")
add("q02_spread", "p10:f p90:f", adhoc.spread, "(SELECT quantile_cont(actual, 0.1) AS p10, quantile_cont(actual, 0.9) AS p90 FROM kn)")
add("q03_best_and_worst_slots", "label mean_job:f working_mean:f non_working_mean:f rank_lowest:i", adhoc.best_and_worst_slots, "slots WHERE rank_lowest <= 5 OR rank_lowest >= 46")
add("q04_week_extremes", "day_name label mean_job:f jobs:i side", adhoc.week_extremes,
    "(SELECT *, 'best' AS side FROM wslots WHERE rank_lowest <= 5 UNION ALL (SELECT *, 'worst' FROM wslots ORDER BY rank_lowest DESC, weekday, time_key LIMIT 3))")
add("q05_savings_listing", "strategy label days:i mean_job:f saving_0900_pct:f kg_per_run:f", lambda w: w.savings.orderBy("sort_order"), "sav")
add("q06_strategy_matrix", "day fixed_0000:f fixed_0900:f fixed_1700:f any_start:f profile_guided:f forecast_guided:f oracle:f", lambda w: w.complete_days.orderBy("day"), "full_days")
add("q07_modal_starts", "year_month label days:i month_days:i", adhoc.modal_starts,
    "(SELECT *, sum(days) OVER (PARTITION BY year_month) AS month_days FROM (SELECT strftime(day, '%Y-%m') AS year_month, label, count(*) AS days FROM full_days JOIN dt ON profile_time_key = dt.time_key GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY year_month ORDER BY days DESC, label) = 1)")
add("q08_excluded_days", "day ts reason", adhoc.excluded_days,
    """(SELECT x.day, hh.ts, CASE WHEN is_missing THEN 'not served' WHEN is_actual_implausible THEN 'implausible actual' WHEN is_forecast_implausible THEN 'implausible forecast' WHEN is_actual_missing THEN 'no actual' END AS reason
    FROM (SELECT CAST(unnest(generate_series(start_date, end_date, INTERVAL 1 DAY)) AS DATE) AS day FROM win EXCEPT SELECT day FROM full_days) x
    LEFT JOIN hh ON local_ts >= x.day AND local_ts < x.day + INTERVAL 28 HOUR AND (is_missing OR is_actual_missing OR is_forecast_implausible))""")  # fmt: skip
add("q09_modal_start", "label days:i", adhoc.modal_start, "(SELECT label, count(*) AS days FROM full_days JOIN dt ON profile_time_key = dt.time_key GROUP BY 1 ORDER BY days DESC, label LIMIT 1)")
add("q10_comparison_listing", "name year:i intensity:f ratio_to_home:f change_pct:f wind_solar_share:f", adhoc.comparison_listing, "(SELECT *, wind_share + solar_share AS wind_solar_share FROM cc)")
add("q11_trend_pivot", "name " + " ".join(f"y{y}:f" for y in adhoc.YEARS), adhoc.trend_pivot, "(SELECT name, " + ", ".join(f"any_value(intensity) FILTER (year = {y}) AS y{y}" for y in adhoc.YEARS) + f" FROM ct WHERE year IN {adhoc.YEARS} GROUP BY name)")
add("q12_country_history", "year:i generation:f intensity:f gas_share:f nuclear_share:f", adhoc.country_history, "ci WHERE country = 'C00' AND year >= 1996")
add("q13_annual_coverage", "year:i mean_actual:f mean_wind_pct:f coverage_pct:f", adhoc.annual_coverage, "(SELECT *, 100.0 * with_actual / (48 * CASE WHEN year % 4 = 0 THEN 366 ELSE 365 END) AS coverage_pct FROM annual)")
add("q14_season_extremes", "season lowest lowest_mean:f highest highest_mean:f", adhoc.season_extremes,
    "(SELECT season, arg_min(label, (mean_actual, label)) AS lowest, min(mean_actual) AS lowest_mean, arg_min(label, (-mean_actual, label)) AS highest, max(mean_actual) AS highest_mean FROM sprof GROUP BY 1)")
add("q15_regions_listing", "region nation mean_forecast:f mean_wind_pct:f mean_low_carbon_pct:f", lambda w: w.regional_report.orderBy("is_aggregate", "mean_forecast"), "rrep")
add("q15_accuracy_listing", "scope scope_value periods:i mae:f bias:f within_10_pct:f mean_actual:f", lambda w: w.forecast_accuracy.orderBy("scope", "scope_value"), "acc")
add("q15_snapshot_listing", "lead_band min_lead:i snapshots:i periods:i mae:f rmse:f bias:f", lambda w: w.snapshot_accuracy.orderBy("min_lead"), "sacc")
add("q16_headline", "profile_share_pct:f forecast_share_pct:f worst_over_best_pct:f kg_saved:f tonnes_a_year:f", adhoc.headline,
    """(SELECT 100.0 * p.saving_0900 / o.saving_0900 AS profile_share_pct, 100.0 * f.saving_0900 / o.saving_0900 AS forecast_share_pct, (SELECT 100.0 * (max(mean_job) - min(mean_job)) / min(mean_job) FROM slots) AS worst_over_best_pct,
    b.kg_per_run - p.kg_per_run AS kg_saved, (b.kg_per_run - p.kg_per_run) * 365 / 1000 AS tonnes_a_year FROM sav p, sav o, sav f, sav b WHERE p.strategy = 'profile_guided' AND o.strategy = 'oracle' AND f.strategy = 'forecast_guided' AND b.strategy = 'fixed_0900')""")  # fmt: skip
add("q21_kpis", "week_mean:f window_mean:f best_start saving_0900_pct:f mae:f", adhoc.kpis,
    """(SELECT (SELECT avg(actual) FROM fn WHERE ts > (SELECT max(ts) FROM fn WHERE actual IS NOT NULL) - INTERVAL 7 DAY) AS week_mean, (SELECT avg(actual) FROM kn) AS window_mean, (SELECT label FROM slots ORDER BY rank_lowest, time_key LIMIT 1) AS best_start,
    (SELECT saving_0900_pct FROM sav WHERE strategy = 'profile_guided') AS saving_0900_pct, (SELECT mae FROM acc WHERE scope = 'report_window') AS mae)""")  # fmt: skip
add("q22_last_two_days", "ts forecast:i actual:i", adhoc.last_two_days, "fn WHERE ts > (SELECT max(ts) FROM fn WHERE actual IS NOT NULL) - INTERVAL 2 DAY")
add("q22_latest_snapshot", "issued ts lead_minutes:i forecast:i", adhoc.latest_snapshot, "snap WHERE issued = (SELECT max(issued) FROM snap) AND lead_minutes >= 0")
add("q23_week_matrix", "weekday:i " + " ".join(f"s{k:02d}:f" for k in range(48)), adhoc.week_matrix, "(SELECT weekday, " + ", ".join(f"max(mean_actual) FILTER (time_key = {k}) AS s{k:02d}" for k in range(48)) + " FROM weekly GROUP BY 1)")
add("q25_annual_csv", "country name year:i intensity:f is_latest", _annual_csv, "(SELECT country, area AS name, year, round(intensity, 1) AS intensity, year = latest_year AS is_latest FROM ci JOIN dc USING (country) WHERE peer_group IN ('GCC', 'UK', 'EU') AND year >= 1990)")
add("q26_export_tail", "moment forecast:i actual:i wind_pct:f gas_pct:f", adhoc.export_tail, "(SELECT strftime(ts, '%Y-%m-%d %H:%M') AS moment, forecast, actual, round(wind_pct, 3) AS wind_pct, round(gas_pct, 3) AS gas_pct FROM fn WHERE ts >= (SELECT max(ts) FROM fn) - INTERVAL 365 DAY)")
add("q27_daily_rollup", "day mean_actual:f min_actual:i max_actual:i mae:f low_carbon_pct:f periods:i", adhoc.daily_rollup, "(SELECT day, avg(actual) AS mean_actual, min(actual) AS min_actual, max(actual) AS max_actual, avg(abs(error)) AS mae, avg(low_carbon_pct) AS low_carbon_pct, count(actual) AS periods FROM fd GROUP BY 1)")
add("q28_daily_mix", "day fuel mean_share:f periods:i", adhoc.daily_mix, "(SELECT day, fuel, avg(share) AS mean_share, count(*) AS periods FROM fm JOIN dd USING (date_key) GROUP BY ALL)")
add("q29_daily_regional", "day region_id:i mean_forecast:f periods:i", adhoc.daily_regional, "(SELECT day, region_id, avg(forecast) AS mean_forecast, count(forecast) AS periods FROM freg JOIN dd USING (date_key) GROUP BY ALL)")
add("q30_measures", "mean_actual:f mae:f mape_pct:f low_carbon_pct:f evening_premium_pct:f lowest_half_hour", adhoc.measures,
    """(SELECT avg(actual) AS mean_actual, avg(abs(error)) AS mae, 100.0 * avg(abs(error) / actual) FILTER (actual > 0) AS mape_pct, avg(low_carbon_pct) AS low_carbon_pct, 100.0 * avg(actual) FILTER (is_evening_peak) / avg(actual) - 100 AS evening_premium_pct,
    (SELECT arg_min(label, (m, label)) FROM (SELECT label, avg(actual) AS m FROM fn JOIN dt USING (time_key) GROUP BY 1)) AS lowest_half_hour FROM fn JOIN dt USING (time_key))""")  # fmt: skip
add("q31_same_period_last_year", "month mean_value:f before:f change_pct:f", adhoc.same_period_last_year,
    """(WITH m AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, sum(value * orders) / sum(orders) AS mean_value FROM dayord GROUP BY 1)
    SELECT m.*, b.mean_value AS before, 100.0 * (m.mean_value - b.mean_value) / b.mean_value AS change_pct FROM m LEFT JOIN m b ON m.month = b.month + INTERVAL 12 MONTH)""")  # fmt: skip
add("q32_weighted_shares", "fuel weighted_share:f periods:i", adhoc.weighted_shares, "(SELECT fuel, sum(mean_share * periods) / sum(periods) AS weighted_share, sum(periods) AS periods FROM fregmix GROUP BY 1)")
add("q33_weighted_intensity", "peer_group year:i intensity:f ratio_to_home:f change_pct:f", adhoc.weighted_intensity,
    """(WITH g AS (SELECT peer_group, year, 1000.0 * sum(emissions) / sum(generation) AS intensity FROM ct0 GROUP BY ALL)
    SELECT g.*, g.intensity / h.intensity AS ratio_to_home, 100.0 * (g.intensity - b.intensity) / b.intensity AS change_pct FROM g LEFT JOIN g h ON h.year = g.year AND h.peer_group = 'UK' LEFT JOIN g b ON b.peer_group = g.peer_group AND b.year = 1996)""")  # fmt: skip

# ---- checks: the rows that break a rule ----
add("qc01_accepted_range", "ts actual:i", lambda w: quality.accepted_range(w.raw.national, "actual", 20, 90), "nat WHERE actual < 20 OR actual > 90")
add("qc02_aligned", "day", lambda w: quality.aligned(w.raw.table("events").withColumn("ts", F.col("ts").cast("timestamp_ntz")).withColumn("day", F.to_date("ts")), "ts").groupBy("day").agg(F.count(F.lit(1)).alias("n")).filter("n > 0"),
    "(SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE strftime(ts, '%M:%S.%f') NOT IN ('00:00.000000', '30:00.000000'))")
add("qc03_unexpected_gaps", "region_id:i start_ts end_ts missing:i", lambda w: quality.unexpected_gaps(w.raw.regional, ["region_id"], "ts", w.raw.known_gaps, "regional"),
    """(SELECT * FROM (SELECT region_id, ts + INTERVAL 30 MINUTE AS start_ts, lead(ts) OVER (PARTITION BY region_id ORDER BY ts) AS end_ts, date_diff('minute', ts, lead(ts) OVER (PARTITION BY region_id ORDER BY ts)) // 30 - 1 AS missing FROM rawreg) g
    WHERE end_ts > start_ts AND NOT EXISTS (SELECT 1 FROM known k WHERE k.dataset = 'regional' AND g.start_ts >= k.start_ts AND g.end_ts <= k.end_ts))""")  # fmt: skip
# faults are put in: every third half-hour of the day lacks three points of gas
add("qc04_shares_sum", "ts total:f", lambda w: quality.shares_sum(w.raw.mix.withColumn("share", F.when((F.col("fuel") == "gas") & (fn.slot("ts") % 3 == 0), F.col("share") - 3).otherwise(F.col("share"))), "share", ["ts"]),
    "(SELECT ts, sum(share - CASE WHEN fuel = 'gas' AND (hour(ts) * 2 + minute(ts) // 30) % 3 = 0 THEN 3 ELSE 0 END) AS total FROM rawmix GROUP BY 1 HAVING round(abs(total - 100), 9) > 1.5)")
add("qc05_unique", "ts rows:i", lambda w: quality.unique(w.raw.mix, ["ts"]), "(SELECT ts, count(*) AS rows FROM rawmix GROUP BY 1 HAVING count(*) > 1)")
add("qc06_not_null", "ts", lambda w: quality.not_null(w.half_hours, "actual"), "hh WHERE actual IS NULL")
add("qc07_accepted_values", "ts band", lambda w: quality.accepted_values(w.raw.national, "band", ["low", "moderate", "high"]), "nat WHERE band NOT IN ('low', 'moderate', 'high')")
add("qc08_foreign_key", "ts fuel", lambda w: quality.foreign_key(w.raw.mix, "fuel", w.raw.fuels.filter("is_low_carbon"), "fuel"), "rawmix WHERE fuel NOT IN (SELECT fuel FROM fuels WHERE is_low_carbon)")
add("qc10_calendar_covered", "first_year:i last_year:i", lambda w: quality.calendar_covered(w.dim_date, "day", w.raw.holidays, "day", 1),
    "(SELECT min(year(day)) AS first_year, max(year(day)) + 1 AS last_year FROM dd HAVING max(year(day)) + 1 > (SELECT max(year(day)) FROM hol) OR min(year(day)) < (SELECT min(year(day)) FROM hol))")
add("qc11_lagging", "area latest:i", lambda w: quality.lagging(w.raw.yearly.withColumn("year", F.when(F.col("area").isin("NATION_1", "NATION_2"), F.least("year", F.lit(1997))).otherwise(F.col("year"))), "area", "year"),
    "(SELECT area, max(year) AS latest FROM yearly WHERE NOT (area IN ('NATION_1', 'NATION_2') AND year > 1997) GROUP BY 1 HAVING max(year) < (SELECT max(year) FROM yearly) - 2)")
add("qc12_stale", "newest", lambda w: quality.stale(w.raw.national, "ts", 36, fn.as_of("2024-04-20 00:00:00")), "(SELECT max(ts) AS newest FROM nat HAVING max(ts) < TIMESTAMP '2024-04-20' - INTERVAL 36 HOUR)")
add("qc13_disagrees", "area year:i intensity:f derived:f", lambda w: quality.disagrees(w.raw.yearly.filter("is_total"), "intensity", F.floor(F.lit(1000.0) * F.col("emissions") / F.col("generation") / 10) * 10),
    "(SELECT * FROM (SELECT area, year, intensity, floor(1000.0 * emissions / generation / 10) * 10 AS derived FROM yearly WHERE is_total) WHERE abs(intensity - derived) > 0.02 * abs(derived))")


def _late_oracle(days):
    """Days with a fault put in: every third has the mean start where the best one should stand."""
    return days.withColumn("oracle", F.when(F.dayofmonth("day") % 3 == 0, F.col("any_start")).otherwise(F.col("oracle")))


def _windows(w):
    """A report window for each week of data, every third with its ends exchanged."""
    weeks = w.raw.national.groupBy(F.weekofyear("ts").alias("week")).agg(F.to_date(F.min("ts")).alias("a"), F.to_date(F.max("ts")).alias("z"))
    turned = F.col("week") % 3 == 0
    return weeks.select(F.when(turned, F.col("z")).otherwise(F.col("a")).alias("start_date"), F.when(turned, F.col("a")).otherwise(F.col("z")).alias("end_date"))


add("qc14_oracle_never_beaten", "day oracle:f", lambda w: quality.beaten(_late_oracle(w.complete_days), "oracle", ["fixed_0000", "fixed_0900", "fixed_1700", "profile_guided", "forecast_guided"]),
    "(SELECT * FROM (SELECT * REPLACE (CASE WHEN day(day) % 3 = 0 THEN any_start ELSE oracle END AS oracle) FROM full_days) WHERE oracle > least(fixed_0000, fixed_0900, fixed_1700, profile_guided, forecast_guided) + 1e-9)")
add("qc15_bad_window", "start_date end_date", lambda w: quality.bad_window(_windows(w)),
    "(SELECT max(CAST(ts AS DATE)) AS start_date, min(CAST(ts AS DATE)) AS end_date FROM nat GROUP BY weekofyear(ts) HAVING weekofyear(ts) % 3 = 0 AND max(CAST(ts AS DATE)) > min(CAST(ts AS DATE)))")


def _suite(w):
    """Rules over rows take one scan together; checks over groups or other tables one each."""
    of_rows = quality.check_rows(w.raw.national, [
        quality.Rule("actual_in_range", F.col("actual").between(20, 90), None, 1, 100),
        quality.Rule("morning_in_range", F.col("actual").between(20, 90), F.hour("ts") < 12, 1, 100),
        quality.Rule("forecast_present", F.col("forecast").isNotNull(), F.col("actual").isNotNull(), 1, 1_000_000),
    ])
    return of_rows.unionByName(quality.run_suite([
        quality.Check("time_unique", quality.unique(w.raw.national, ["ts"])),
        quality.Check("fuel_known", quality.foreign_key(w.raw.mix, "fuel", w.raw.fuels, "fuel")),
        quality.Check("actual_present", quality.not_null(w.half_hours, "actual"), 1, 1_000_000),
    ]))


add("qc16_suite", "check_name failures:i status", _suite,
    """(SELECT check_name, failures, CASE WHEN failures >= e THEN 'error' WHEN failures >= 1 THEN 'warn' ELSE 'pass' END AS status FROM (
    SELECT 'actual_in_range' AS check_name, count(*) AS failures, 100 AS e FROM nat WHERE actual < 20 OR actual > 90 UNION ALL
    SELECT 'morning_in_range', count(*), 100 FROM nat WHERE (actual < 20 OR actual > 90) AND hour(ts) < 12 UNION ALL SELECT 'forecast_present', count(*), 1000000 FROM nat WHERE forecast IS NULL AND actual IS NOT NULL UNION ALL SELECT 'time_unique', count(*), 1 FROM (SELECT ts FROM nat GROUP BY 1 HAVING count(*) > 1)
    UNION ALL SELECT 'fuel_known', count(*), 1 FROM rawmix WHERE fuel NOT IN (SELECT fuel FROM fuels) UNION ALL SELECT 'actual_present', count(*), 1000000 FROM hh WHERE actual IS NULL))""")  # fmt: skip

# ---- intervals ----
add("inc1_to_fetch", "region_id:i start_ts end_ts", lambda w: intervals.to_fetch(w.raw.regional.groupBy("region_id").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")), ["region_id"], "2024-03-01 00:00:00", "2024-04-12 00:00:00"),
    """(SELECT * FROM (SELECT region_id, TIMESTAMP '2024-03-01' AS start_ts, min(ts) AS end_ts FROM rawreg GROUP BY 1 UNION ALL
    SELECT region_id, greatest(TIMESTAMP '2024-03-01', least(max(ts) + INTERVAL 30 MINUTE, TIMESTAMP '2024-04-12') - INTERVAL 2 DAY), TIMESTAMP '2024-04-12' FROM rawreg GROUP BY 1) WHERE start_ts < end_ts)""")  # fmt: skip
add("inc2_gaps", "region_id:i start_ts end_ts missing:i", lambda w: intervals.gaps(w.raw.regional, ["region_id"], "ts"),
    "(SELECT * FROM (SELECT region_id, ts + INTERVAL 30 MINUTE AS start_ts, lead(ts) OVER (PARTITION BY region_id ORDER BY ts) AS end_ts, date_diff('minute', ts, lead(ts) OVER (PARTITION BY region_id ORDER BY ts)) // 30 - 1 AS missing FROM rawreg) WHERE end_ts > start_ts)")
_GAPS = "SELECT ts + INTERVAL 30 MINUTE AS start_ts, lead(ts) OVER (PARTITION BY region_id ORDER BY ts) AS end_ts FROM rawreg"
add("inc3_merged_gaps", "start_ts end_ts", lambda w: intervals.merge(intervals.merge(intervals.gaps(w.raw.regional, ["region_id"], "ts"), ["region_id"]), []),
    f"""(WITH g AS (SELECT * FROM ({_GAPS}) WHERE end_ts > start_ts), i AS (SELECT *, CASE WHEN start_ts <= max(end_ts) OVER (ORDER BY start_ts, end_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS f FROM g)
    SELECT min(start_ts) AS start_ts, max(end_ts) AS end_ts FROM (SELECT *, sum(f) OVER (ORDER BY start_ts, end_ts ROWS UNBOUNDED PRECEDING) AS n FROM i) GROUP BY n)""")  # fmt: skip
add("inc5_chunks", "start_ts end_ts days:f", lambda w: intervals.chunks(w.raw.daily_orders.agg(F.min("day").cast("timestamp_ntz").alias("start_ts"), F.max("day").cast("timestamp_ntz").alias("end_ts")), [], 30).withColumn("days", fn.minutes_between("start_ts", "end_ts") / 1440),
    """(WITH b AS (SELECT CAST(min(day) AS TIMESTAMP) AS a, CAST(max(day) AS TIMESTAMP) AS z FROM dayord), y AS (SELECT a, z, unnest(range(CAST(year(a) AS INT), CAST(year(z) AS INT) + 1)) AS y FROM b),
    p AS (SELECT greatest(a, make_timestamp(y, 1, 1, 0, 0, 0) - INTERVAL 30 MINUTE) AS a, least(z, make_timestamp(y + 1, 1, 1, 0, 0, 0) - INTERVAL 30 MINUTE) AS z FROM y)
    SELECT start_ts, least(start_ts + INTERVAL 30 DAY, z) AS end_ts, date_diff('minute', start_ts, least(start_ts + INTERVAL 30 DAY, z)) / 1440.0 AS days FROM (SELECT z, unnest(generate_series(a, z - INTERVAL 1 MICROSECOND, INTERVAL 30 DAY)) AS start_ts FROM p WHERE a < z))""")  # fmt: skip

_LIMITS = {"national": 14, "regional": 5}


def _plan(w):
    """What to fetch of two datasets, a span for the nation and one for each region, cut by each dataset's own limit of days."""
    spans = [w.raw.national.agg(F.lit("national").alias("dataset"), F.lit(0).alias("region_id"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts")), w.raw.regional.groupBy(F.lit("regional").alias("dataset"), "region_id").agg(F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"))]
    return intervals.plan(readers.merge_all(spans), ["region_id"], "dataset", _LIMITS)


add("inc6_plan", "dataset region_id:i start_ts end_ts", _plan,
    f"""(WITH s AS (SELECT 'national' AS dataset, 0 AS region_id, min(ts) AS a, max(ts) AS z, {_LIMITS["national"]} AS most FROM nat UNION ALL SELECT 'regional', region_id, min(ts), max(ts), {_LIMITS["regional"]} FROM rawreg GROUP BY region_id)
    SELECT dataset, region_id, t AS start_ts, least(t + most * INTERVAL 1 DAY, z) AS end_ts FROM (SELECT *, unnest(generate_series(a, z - INTERVAL 1 MICROSECOND, most * INTERVAL 1 DAY)) AS t FROM s))""")  # fmt: skip
