"""The same models in DuckDB SQL over the raw tables: one chain of CTEs that every oracle query starts with."""

from ..sources.bound import FUELS, GROUPS, HOLIDAYS, KINDS, KNOWN_GAPS, PRIORITIES, REGIONS, SHIFT_DAYS
from .warehouse import SOURCES, STRATEGIES


def _case(column: str, mapping: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v!r}" for k, v in mapping.items()) + " END"


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join(str(x) if not isinstance(x, str) else f"'{x}'" for x in r) + ")" for r in rows)


_BAND = "CASE WHEN {0} < 100 THEN 'very low' WHEN {0} < 200 THEN 'low' WHEN {0} < 300 THEN 'moderate' WHEN {0} < 400 THEN 'high' WHEN {0} IS NOT NULL THEN 'very high' END"
_LOCAL = "(({0} AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London')"
_KEY = "CAST(strftime({0}, '%Y%m%d') AS INTEGER)"
_SEASON = "CASE WHEN {0} IN (12, 1, 2) THEN 'Winter' WHEN {0} <= 5 THEN 'Spring' WHEN {0} <= 8 THEN 'Summer' ELSE 'Autumn' END"
_MEAN = "CAST(sum(cents) FILTER ({0}) // nullif(100 * count(*) FILTER ({0}), 0) AS INTEGER)"
_SLOT = "CAST(hour({0}) * 2 + minute({0}) // 30 AS INTEGER)"
ERRORS = """count(*) AS periods, avg(abs(error)) AS mae, sqrt(avg(error * error)) AS rmse, 100.0 * avg(abs(error) / actual) FILTER (actual > 0) AS mape_pct,
  avg(error) AS bias, 100.0 * avg(CAST(abs(error) <= 10 AS INT)) AS within_10_pct, 100.0 * avg(CAST(abs(error) <= 25 AS INT)) AS within_25_pct, avg(actual) AS mean_actual"""


def prelude(low=10, high=700, k=4, lookback=14, least=10, starts=30, kw=100, hours=2, w0="2024-03-11", w1="2024-04-09", members=5, first_year=1990, base_year=1996, home="C01", union="C02", world="C03") -> str:
    inside = "day BETWEEN start_date AND end_date"
    shares = ", ".join(f"max(share) FILTER (source = '{s}') AS {s.lower()}_share" for s in SOURCES)
    zeros = ", ".join(f"coalesce({s.lower()}_share, 0.0) AS {s.lower()}_share" for s in SOURCES)
    labels = _case("strategy", STRATEGIES)
    orders = _case("strategy", {n: i + 1 for i, n in enumerate(STRATEGIES)})
    base = ", ".join(f"max(mean_job) FILTER (strategy = 'fixed_{b}') AS b{b}" for b in ("0000", "0900", "1700"))
    saved = ", ".join(f"b{b} - mean_job AS saving_{b}, 100.0 * (b{b} - mean_job) / b{b} AS saving_{b}_pct" for b in ("0000", "0900", "1700"))
    return f"""
WITH ev AS (
  SELECT time_bucket(INTERVAL 30 MINUTE, ts + INTERVAL {SHIFT_DAYS} DAY) AS ts, CAST(user_id % {REGIONS} + 1 AS INTEGER) AS region_id, event_type, CAST(round(value * 100) AS BIGINT) AS cents FROM events
), nat AS (
  SELECT *, {_BAND.format("actual")} AS band FROM (SELECT ts, {_MEAN.format("event_type IN ('click', 'view', 'signup')")} AS forecast, {_MEAN.format("true")} AS actual FROM ev GROUP BY ts)
), rawmix AS (
  SELECT ts, {_case("event_type", KINDS)} AS fuel, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ts) AS share FROM ev GROUP BY ts, event_type
), rawreg AS (
  SELECT *, {_BAND.format("forecast")} AS band FROM (SELECT ts, region_id, {_MEAN.format("true")} AS forecast FROM ev GROUP BY ts, region_id)
), rawregmix AS (
  SELECT ts, region_id, {_case("event_type", KINDS)} AS fuel, 100.0 * count(*) / sum(count(*)) OVER (PARTITION BY ts, region_id) AS share FROM ev GROUP BY ts, region_id, event_type
), rawsnap AS (
  SELECT d.issued, p.ts, p.forecast FROM (SELECT DISTINCT date_trunc('day', ts)::TIMESTAMP AS issued FROM nat) d
  JOIN (SELECT ts + INTERVAL 2 DAY AS ts, actual AS forecast FROM nat) p ON p.ts BETWEEN d.issued - INTERVAL 30 MINUTE AND d.issued + INTERVAL 48 HOUR
), yr0 AS (
  SELECT n_name AS area, CASE WHEN n_regionkey <> 2 THEN upper(substr(n_name, 1, 3)) END AS code, CAST(year(o_orderdate) AS INTEGER) AS year, o_orderpriority AS pr, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
), yr1 AS (
  SELECT area, code, year, {_case("pr", {p: v[0] for p, v in PRIORITIES.items()})} AS source, cents, cents * {_case("pr", {p: v[1] for p, v in PRIORITIES.items()})} AS grams FROM yr0
), yr2 AS (
  SELECT area, code, year, source, cents, grams FROM yr1 UNION ALL SELECT area, code, year, 'Total generation', sum(cents), sum(grams) FROM yr1 GROUP BY area, code, year
), yearly AS (
  SELECT area, code, year, source, source = 'Total generation' AS is_total, cents / 1e8 AS generation, 100.0 * cents / max(cents) OVER (PARTITION BY area, year) AS share,
    grams / 1e11 AS emissions, CAST(grams AS DOUBLE) / cents AS intensity FROM yr2
), countries AS (
  SELECT n_name AS area, printf('C%02d', CAST(n_nationkey AS INT)) AS country, (list_value({", ".join(repr(g) for g in GROUPS)}))[CAST(n_regionkey + 1 AS INT)] AS peer_group, CAST(n_nationkey AS INT) AS sort_order FROM nation
), fuels(fuel, label, category, is_fossil, is_renewable, is_low_carbon, sort_order) AS (VALUES {_rows(FUELS)}
), regions AS (
  SELECT CAST(i AS INT) AS region_id, 'Region ' || i AS region, CASE WHEN i <= 14 THEN 'Mainland' ELSE 'Aggregate' END AS nation, i > 14 AS is_aggregate FROM range(1, {REGIONS + 1}) t(i)
), hol AS (SELECT CAST(a AS DATE) AS day, min(b) AS holiday FROM (VALUES {_rows(HOLIDAYS)}) t(a, b) GROUP BY 1
), known(dataset, start_ts, end_ts) AS (SELECT d, CAST(a AS TIMESTAMP), CAST(b AS TIMESTAMP) FROM (VALUES {_rows(KNOWN_GAPS)}) t(d, a, b)
), dayord AS (
  SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS orders, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (100 * count(*)) AS value FROM orders GROUP BY 1
), grid AS (SELECT unnest(generate_series((SELECT min(ts) FROM nat), (SELECT max(ts) FROM nat), INTERVAL 30 MINUTE)) AS ts
), hh AS (
  SELECT g.ts, g.ts + INTERVAL 30 MINUTE AS end_ts, l AS local_ts, CAST(l AS DATE) AS local_date, {_KEY.format("l")} AS date_key, {_SLOT.format("l")} AS time_key,
    CASE WHEN forecast BETWEEN {low} AND {high} THEN forecast END AS forecast, CASE WHEN actual BETWEEN {low} AND {high} THEN actual END AS actual, band, n.ts IS NULL AS is_missing,
    coalesce(forecast NOT BETWEEN {low} AND {high}, false) AS is_forecast_implausible, coalesce(actual NOT BETWEEN {low} AND {high}, false) AS is_actual_implausible,
    coalesce(actual NOT BETWEEN {low} AND {high}, true) AS is_actual_missing
  FROM (SELECT ts, {_LOCAL.format("ts")} AS l FROM grid) g LEFT JOIN nat n ON g.ts = n.ts
), wide AS (
  SELECT ts, {", ".join(f"sum(share) FILTER (fuel = '{f[0]}') AS {f[0]}_pct" for f in FUELS)}, coalesce(sum(share) FILTER (is_fossil), 0) AS fossil_pct,
    coalesce(sum(share) FILTER (is_renewable), 0) AS renewable_pct, coalesce(sum(share) FILTER (is_low_carbon), 0) AS low_carbon_pct, sum(share) AS total_pct FROM rawmix JOIN fuels USING (fuel) GROUP BY ts
), jobs AS (
  SELECT ts, local_ts, local_date AS day, date_key, time_key, a AS job_actual, f AS job_forecast FROM (
    SELECT *, avg(actual) OVER j AS a, count(actual) OVER j AS na, avg(forecast) OVER j AS f, count(forecast) OVER j AS nf, count(*) OVER j AS n FROM hh WINDOW j AS (ORDER BY ts ROWS BETWEEN CURRENT ROW AND {k - 1} FOLLOWING)
  ) WHERE n = {k} AND na = {k} AND nf = {k}
), dd AS (
  SELECT {_KEY.format("day")} AS date_key, d.day, CAST(year(d.day) AS INT) AS year, quarter(d.day) AS quarter, CAST(month(d.day) AS INT) AS month, monthname(d.day) AS month_name, strftime(d.day, '%Y-%m') AS year_month, day(d.day) AS day_of_month,
    CAST(isodow(d.day) AS INT) AS weekday, dayname(d.day) AS day_name, isodow(d.day) > 5 AS is_weekend, holiday IS NOT NULL AS is_holiday, holiday, isodow(d.day) < 6 AND holiday IS NULL AS is_working_day, {_SEASON.format("month(d.day)")} AS season
  FROM (SELECT CAST(unnest(generate_series((SELECT min(local_date) FROM hh), (SELECT max(local_date) + 2 FROM hh), INTERVAL 1 DAY)) AS DATE) AS day) d LEFT JOIN hol USING (day)
), dt AS (
  SELECT CAST(i AS INT) AS time_key, printf('%02d:%02d', CAST(i // 2 AS INT), CAST(i % 2 * 30 AS INT)) AS label, i // 2 AS hour, i % 2 * 30 AS minute,
    CASE WHEN i < 14 THEN 'Night' WHEN i < 24 THEN 'Morning' WHEN i < 32 THEN 'Afternoon' WHEN i < 38 THEN 'Evening peak' ELSE 'Evening' END AS day_part, i BETWEEN 32 AND 37 AS is_evening_peak FROM range(48) t(i)
), cy AS (
  SELECT country, year, generation, emissions, intensity, {zeros}, coalesce(gas_share, 0) + coalesce(coal_share, 0) AS fossil_share, coalesce(nuclear_share, 0) + coalesce(solar_share, 0) + coalesce(wind_share, 0) AS clean_share FROM (
    SELECT area, year, max(generation) FILTER (is_total) AS generation, max(emissions) FILTER (is_total) AS emissions, max(intensity) FILTER (is_total) AS intensity, {shares} FROM yearly GROUP BY area, year
  ) JOIN countries USING (area) WHERE generation IS NOT NULL
), dc AS (
  SELECT c.*, first_year, latest_year FROM countries c LEFT JOIN (SELECT country, min(year) AS first_year, max(year) AS latest_year FROM cy GROUP BY 1) USING (country)
), fn AS (SELECT hh.*, forecast - actual AS error, wide.ts IS NULL AS is_mix_missing, wide.* EXCLUDE (ts) FROM hh LEFT JOIN wide ON hh.ts = wide.ts
), fm AS (SELECT m.*, date_key, time_key FROM rawmix m JOIN hh USING (ts)
), freg AS (SELECT ts, region_id, {_KEY.format(_LOCAL.format("ts"))} AS date_key, {_SLOT.format(_LOCAL.format("ts"))} AS time_key, {_LOCAL.format("ts")} AS local_ts, forecast, band FROM rawreg
), fregmix AS (SELECT {_KEY.format(_LOCAL.format("ts"))} AS date_key, region_id, fuel, avg(share) AS mean_share, count(*) AS periods FROM rawregmix GROUP BY ALL
), snap AS (
  SELECT issued, s.ts, date_diff('minute', issued, s.ts) AS lead_minutes, {_KEY.format(_LOCAL.format("s.ts"))} AS date_key, s.clean AS forecast, bad AS is_forecast_implausible, hh.actual, s.clean - hh.actual AS error
  FROM (SELECT *, CASE WHEN forecast BETWEEN {low} AND {high} THEN forecast END AS clean, coalesce(forecast NOT BETWEEN {low} AND {high}, false) AS bad FROM rawsnap) s LEFT JOIN hh ON s.ts = hh.ts
), elec AS (SELECT country, y.* EXCLUDE (area, code) FROM yearly y JOIN countries USING (area)
), ci AS (SELECT *, intensity - lag(intensity) OVER (PARTITION BY country ORDER BY year) AS change FROM cy
), autowin AS (
  SELECT CASE WHEN z >= a THEN a ELSE first END AS start_date, CASE WHEN z >= a THEN z ELSE last END AS end_date FROM (
    SELECT *, greatest(first, CAST(date_trunc('month', z) - INTERVAL 11 MONTH AS DATE)) AS a FROM (
      SELECT *, CASE WHEN last = last_day(last) THEN last ELSE CAST(date_trunc('month', last) AS DATE) - 1 END AS z FROM (
        SELECT min(local_date) AS first, max(local_date) AS last FROM hh WHERE NOT is_actual_missing)))
), win AS (SELECT DATE '{w0}' AS start_date, DATE '{w1}' AS end_date
), fd AS (SELECT * FROM fn JOIN dd USING (date_key)
), kn AS (SELECT fd.* FROM fd, win WHERE {inside} AND actual IS NOT NULL
), jd AS (SELECT jobs.* EXCLUDE (day), dd.* EXCLUDE (date_key) FROM jobs JOIN dd USING (date_key), win WHERE dd.{inside}
), slots AS (
  SELECT time_key, label, mean_job, working_mean, non_working_mean, jobs, rank() OVER (ORDER BY mean_job) AS rank_lowest FROM (
    SELECT time_key, avg(job_actual) AS mean_job, avg(job_actual) FILTER (is_working_day) AS working_mean, avg(job_actual) FILTER (NOT is_working_day) AS non_working_mean, count(*) AS jobs FROM jd GROUP BY 1) JOIN dt USING (time_key)
), wslots AS (SELECT *, rank() OVER (ORDER BY mean_job) AS rank_lowest FROM (SELECT weekday, day_name, time_key, label, avg(job_actual) AS mean_job, count(*) AS jobs FROM jd JOIN dt USING (time_key) GROUP BY ALL)
), trail AS (
  SELECT day, time_key, avg(m) OVER t AS mean_before, count(m) OVER t AS seen FROM (SELECT day, time_key, avg(job_actual) AS m FROM jobs GROUP BY ALL)
  WINDOW t AS (PARTITION BY time_key ORDER BY day RANGE BETWEEN INTERVAL {lookback + 1} DAY PRECEDING AND INTERVAL 2 DAY PRECEDING)
), choice AS (SELECT day, time_key AS profile_time_key FROM trail WHERE seen >= {least} AND mean_before IS NOT NULL QUALIFY row_number() OVER (PARTITION BY day ORDER BY mean_before, time_key) = 1
), rules AS (
  SELECT day, date_key, count(*) AS start_options, max(job_actual) FILTER (time_key = 0) AS fixed_0000, max(job_actual) FILTER (time_key = 18) AS fixed_0900, max(job_actual) FILTER (time_key = 34) AS fixed_1700, avg(job_actual) AS any_start,
    arg_min(job_actual, (job_forecast, time_key)) AS forecast_guided, arg_min(time_key, (job_forecast, time_key)) AS forecast_time_key, min(job_actual) AS oracle, arg_min(time_key, (job_actual, time_key)) AS oracle_time_key FROM jobs GROUP BY ALL
), daily AS (
  SELECT r.*, c.profile_time_key, c.profile_guided FROM rules r LEFT JOIN (
    SELECT choice.day, profile_time_key, max(job_actual) AS profile_guided FROM choice JOIN jobs ON choice.day = jobs.day AND profile_time_key = time_key GROUP BY ALL) c ON r.day = c.day, win
  WHERE r.{inside} AND start_options >= {starts} AND fixed_0000 IS NOT NULL AND fixed_0900 IS NOT NULL AND fixed_1700 IS NOT NULL
), full_days AS (SELECT * FROM daily WHERE profile_guided IS NOT NULL AND forecast_guided IS NOT NULL
), longs AS ({" UNION ALL ".join(f"SELECT day, '{s}' AS strategy, CAST({s} AS DOUBLE) AS value FROM full_days" for s in STRATEGIES)}
), means AS (SELECT strategy, avg(value) AS mean_job, count(*) AS days FROM longs WHERE value IS NOT NULL GROUP BY 1
), sav AS (
  SELECT strategy, {labels} AS label, {orders} AS sort_order, days, mean_job, {saved}, {float(kw)} AS job_kw, {float(hours)} AS job_hours, mean_job * {kw} * {hours} / 1000 AS kg_per_run FROM means, (SELECT {base} FROM means)
), weekly AS (SELECT weekday, day_name, time_key, label, avg(actual) AS mean_actual, quantile_cont(actual, 0.5) AS median_actual, count(*) AS periods FROM kn JOIN dt USING (time_key) GROUP BY ALL
), monthly AS (
  SELECT year_month, year, month, season, min(day) AS month_start, avg(actual) AS mean_actual, quantile_cont(actual, 0.1) AS p10_actual, quantile_cont(actual, 0.9) AS p90_actual, min(actual) AS min_actual, max(actual) AS max_actual,
    avg(wind_pct) AS mean_wind_pct, avg(solar_pct) AS mean_solar_pct, avg(gas_pct) AS mean_gas_pct, avg(low_carbon_pct) AS mean_low_carbon_pct, count(actual) AS with_actual, count(*) AS periods, 100.0 * count(actual) / count(*) AS coverage_pct FROM fd GROUP BY ALL
), annual AS (
  SELECT year, avg(actual) AS mean_actual, avg(low_carbon_pct) AS mean_low_carbon_pct, avg(wind_pct) AS mean_wind_pct, avg(gas_pct) AS mean_gas_pct, avg(coal_pct) AS mean_coal_pct, count(actual) AS with_actual, min(day) AS first_date, max(day) AS last_date,
    count(actual) >= 0.99 * 48 * (CASE WHEN year % 4 = 0 THEN 366 ELSE 365 END) AS is_complete FROM fd GROUP BY year
), sprof AS (SELECT season, time_key, label, avg(actual) AS mean_actual, avg(solar_pct) AS mean_solar_pct, avg(wind_pct) AS mean_wind_pct, count(*) AS periods FROM kn JOIN dt USING (time_key) GROUP BY ALL
), ssum AS (
  SELECT a.*, mean_daily_range, days, CASE season WHEN 'Winter' THEN 1 WHEN 'Spring' THEN 2 WHEN 'Summer' THEN 3 ELSE 4 END AS season_order FROM (
    SELECT season, avg(actual) AS mean_actual, quantile_cont(actual, 0.1) AS p10_actual, quantile_cont(actual, 0.9) AS p90_actual, avg(wind_pct) AS mean_wind_pct, avg(solar_pct) AS mean_solar_pct, avg(gas_pct) AS mean_gas_pct, count(*) AS periods FROM kn GROUP BY 1) a
  JOIN (SELECT season, avg(r) AS mean_daily_range, count(*) AS days FROM (SELECT season, day, max(actual) - min(actual) AS r FROM kn GROUP BY ALL) GROUP BY 1) USING (season)
), rlevel AS (
  SELECT region_id, avg(forecast) AS mean_forecast, {", ".join(f"avg(forecast) FILTER (season = '{s}') AS {s.lower()}_mean" for s in ("Winter", "Spring", "Summer", "Autumn"))}, quantile_cont(forecast, 0.1) AS p10_forecast, quantile_cont(forecast, 0.9) AS p90_forecast, count(*) AS periods
  FROM freg JOIN dd USING (date_key), win WHERE {inside} AND forecast IS NOT NULL GROUP BY 1
), rmix AS (
  SELECT region_id, sum(mean_share * periods) FILTER (fuel = 'wind') / nw AS mean_wind_pct, sum(mean_share * periods) FILTER (is_low_carbon) / nw AS mean_low_carbon_pct, sum(mean_share * periods) FILTER (is_fossil) / nw AS mean_fossil_pct
  FROM (SELECT *, sum(CASE WHEN fuel = 'wind' THEN periods END) OVER (PARTITION BY region_id) AS nw FROM fregmix JOIN fuels USING (fuel) JOIN dd USING (date_key), win WHERE {inside}) GROUP BY region_id, nw
), rrep AS (
  SELECT *, CASE WHEN NOT is_aggregate THEN rank() OVER (PARTITION BY is_aggregate ORDER BY mean_forecast) END AS rank_lowest FROM rlevel JOIN regions USING (region_id) LEFT JOIN rmix USING (region_id)
), pairs AS (SELECT year, season, day, error, actual FROM fd WHERE error IS NOT NULL
), acc AS (
  SELECT scope, scope_value, {ERRORS} FROM (
    SELECT 'year' AS scope, CAST(year AS VARCHAR) AS scope_value, error, actual FROM pairs
    UNION ALL SELECT 'season', season, error, actual FROM pairs, win WHERE {inside}
    UNION ALL SELECT 'report_window', start_date || ' to ' || end_date, error, actual FROM pairs, win WHERE {inside}) GROUP BY ALL
), sacc AS (
  SELECT CASE WHEN lead_minutes < 0 THEN 'already started' WHEN lead_minutes < 360 THEN '0-6 h' WHEN lead_minutes < 720 THEN '6-12 h' WHEN lead_minutes < 1440 THEN '12-24 h' ELSE '24-48 h' END AS lead_band,
    min(lead_minutes) AS min_lead, count(DISTINCT issued) AS snapshots, {ERRORS} FROM snap WHERE error IS NOT NULL GROUP BY 1
), ct0 AS (SELECT country, area AS name, peer_group, year, generation, emissions, intensity FROM ci JOIN dc USING (country) WHERE year >= {first_year}
), ct AS (
  SELECT *, false AS is_aggregate FROM ct0 UNION ALL
  SELECT 'GCC', 'GCC (weighted)', 'GCC aggregate', year, sum(generation), sum(emissions), 1000.0 * sum(emissions) / sum(generation), true FROM ct0 WHERE peer_group = 'GCC' GROUP BY year HAVING count(*) = {members}
), latest AS (SELECT * FROM ct WHERE year = (SELECT min(y) FROM (SELECT max(year) AS y FROM ct WHERE country <> '{world}' GROUP BY country))
), cc AS (
  SELECT l.*, base_intensity, intensity / (SELECT max(intensity) FROM latest WHERE country = '{home}') AS ratio_to_home, intensity / (SELECT max(intensity) FROM latest WHERE country = '{union}') AS ratio_to_union,
    100.0 * (intensity - base_intensity) / base_intensity AS change_pct, fossil_share, gas_share, coal_share, nuclear_share, solar_share, wind_share, clean_share
  FROM latest l LEFT JOIN (SELECT country, intensity AS base_intensity FROM ct WHERE year = {base_year}) USING (country) LEFT JOIN (SELECT country, year, fossil_share, gas_share, coal_share, nuclear_share, solar_share, wind_share, clean_share FROM ci) USING (country, year)
), series AS (SELECT CAST((epoch(ts) - min(epoch(ts)) OVER ()) / 1800 AS BIGINT) AS idx, ts, CAST(actual AS DOUBLE) AS actual, CAST(forecast AS DOUBLE) AS forecast FROM hh
)"""


def typed(spec: str, source: str) -> str:
    """SELECT of a spec "a:i b:f c" (i whole number, f rounded to 6 digits, else as it is) from a source."""
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        out.append({"i": f"CAST({name} AS BIGINT) AS {name}", "f": f"round(CAST({name} AS DOUBLE), 6) AS {name}"}.get(kind, name))
    return f"SELECT {', '.join(out)} FROM {source}"
