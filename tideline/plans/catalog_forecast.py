"""Names, columns and SQL of forecasting and statistics."""

from functools import partial

from pyspark.sql import functions as F

from ..operators.series import numbered
from ..sources import sinks
from ..sources.bound import HOLIDAYS
from ..streaming import feeds
from . import forecasting as fc
from . import stats
from .catalog import add
from .oracle import ERRORS

_CAL = f"""cal AS (SELECT idx, CAST(hour(l) * 2 + minute(l) // 30 AS DOUBLE) AS slot, CAST(isodow(l) - 1 AS DOUBLE) AS weekday, CASE WHEN CAST(l AS DATE) IN ({", ".join(f"DATE '{d}'" for d, _ in HOLIDAYS)}) THEN 1.0 ELSE 0.0 END AS holiday,
  sin(2 * pi() * (dayofyear(l) - 1) / 365.25) AS doy_sin, cos(2 * pi() * (dayofyear(l) - 1) / 365.25) AS doy_cos FROM (SELECT idx, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London' AS l FROM series UNION ALL
  SELECT m + k, ((t + k * INTERVAL 30 MINUTE) AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London' FROM (SELECT max(idx) AS m, max(ts) AS t FROM series), range(1, 97) r(k)))"""
_TRAIL = """tr AS (SELECT idx, actual AS last, lag(actual) OVER o AS previous, avg(actual) OVER d AS mean_24h, avg(actual) OVER k AS mean_7d, stddev_pop(actual) OVER d AS std_24h, min(actual) OVER d AS min_24h, max(actual) OVER d AS max_24h, actual - lag(actual, 48) OVER o AS change_24h
  FROM series WINDOW o AS (ORDER BY idx), d AS (ORDER BY idx ROWS BETWEEN 47 PRECEDING AND CURRENT ROW), k AS (ORDER BY idx ROWS BETWEEN 335 PRECEDING AND CURRENT ROW)),
  prof AS (SELECT idx, actual AS latest_slot, avg(actual) OVER (PARTITION BY idx % 48 ORDER BY idx ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS slot_profile FROM series)"""
_ORIG = """org AS (SELECT idx, issue, (row_number() OVER (ORDER BY idx) - 1) // 28 AS fold FROM (SELECT idx, ts + INTERVAL 30 MINUTE AS issue FROM series WHERE ts + INTERVAL 30 MINUTE >= date_trunc('day', (SELECT min(ts) FROM series)) + INTERVAL 1 DAY
  AND hour(ts + INTERVAL 30 MINUTE) = 0 AND minute(ts) = 30 AND idx <= (SELECT max(idx) FROM series WHERE actual IS NOT NULL) - 96 ORDER BY idx DESC LIMIT 365))"""
_REL = ", ".join(f"{n} - last AS {n}_rel" for n in fc.RELATIVE)
_FEAT = f"""ft AS (SELECT *, {_REL} FROM (SELECT o.idx AS origin, o.idx + h AS target, CAST(h AS DOUBLE) AS horizon, cal.* EXCLUDE (idx), tr.* EXCLUDE (idx), prof.latest_slot, prof.slot_profile, w1.actual AS back_1w, w2.actual AS back_2w, v.actual, v.forecast AS api_forecast
  FROM org o CROSS JOIN range(1, 97) r(h) JOIN tr ON tr.idx = o.idx JOIN cal ON cal.idx = o.idx + h LEFT JOIN series v ON v.idx = o.idx + h LEFT JOIN series w1 ON w1.idx = o.idx + h - 336 LEFT JOIN series w2 ON w2.idx = o.idx + h - 672
  LEFT JOIN prof ON prof.idx = o.idx + h - CAST(ceil(h / 48.0) * 48 AS BIGINT)))"""
_PRED = """pr AS (SELECT issue, ts AS target_ts, CAST(horizon AS INT) AS horizon, f.actual, slot_profile AS model, last AS persistence, latest_slot AS naive_yesterday, back_1w AS naive_last_week, api_forecast, slot_profile - std_24h AS model_p10, slot_profile + std_24h AS model_p90, fold
  FROM ft f JOIN org ON org.idx = origin JOIN series s ON s.idx = target),
  cm AS (SELECT * FROM pr WHERE actual IS NOT NULL AND model IS NOT NULL AND persistence IS NOT NULL AND naive_yesterday IS NOT NULL AND naive_last_week IS NOT NULL AND api_forecast IS NOT NULL AND model_p10 IS NOT NULL)"""
_WITH = f"(WITH {_CAL}, {_TRAIL}, {_ORIG}, {_FEAT}, {_PRED} SELECT * FROM "
_MAE = ", ".join(f"avg(abs({m} - actual)) AS mae_{m}" for m in fc.METHODS)
_COVER = "100.0 * avg(CAST(actual BETWEEN model_p10 AND model_p90 AS INT)) AS coverage_pct"


def _bands(bands) -> str:
    return "(VALUES " + ", ".join(f"('{n}', {a}, {b})" for n, a, b in bands) + ") bb(band, lo, hi)"


def _setup(w):
    series = fc.national_series(w)
    cal = fc.calendar(series, w.raw.holidays)
    origins = fc.daily_origins(series)
    return series, cal, origins


def _features(w):
    return fc.features(*_setup(w))


def _predictions(w):
    series, cal, origins = _setup(w)
    return fc.prediction_table(fc.stand_in(fc.features(series, cal, origins)), origins, series)


add("f01_calendar", "idx:i slot:f weekday:f holiday:f doy_sin:f doy_cos:f", lambda w: _setup(w)[1], f"(WITH {_CAL} SELECT * FROM cal)")
add("f02_features", "origin:i target:i " + " ".join(f"{f}:f" for f in fc.FEATURES), _features, _WITH + "ft)")
add("f15_daily_origins", "idx:i issue fold:i", lambda w: _setup(w)[2], _WITH + "org)")
add("f17_predictions", "issue target_ts horizon:i actual:f " + " ".join(f"{m}:f" for m in fc.METHODS) + " model_p10:f model_p90:f fold:i", _predictions, _WITH + "pr)")
add("f18_by_method", "band method periods:i mae:f rmse:f mape_pct:f bias:f within_10_pct:f within_25_pct:f", lambda w: fc.by_method(_predictions(w)),
    _WITH + f"(SELECT band, method, {ERRORS} FROM (SELECT *, value - actual AS error FROM ({' UNION ALL '.join(f'''SELECT horizon, actual, '{m}' AS method, {m} AS value FROM cm''' for m in fc.METHODS)})) JOIN {_bands(fc.BANDS)} ON horizon BETWEEN lo AND hi GROUP BY ALL))")
add("f19_interval_coverage", "band n:i coverage_pct:f mean_width:f", lambda w: fc.interval_coverage(_predictions(w)), _WITH + f"(SELECT band, count(*) AS n, {_COVER}, avg(model_p90 - model_p10) AS mean_width FROM cm JOIN {_bands(fc.BANDS)} ON horizon BETWEEN lo AND hi GROUP BY 1))")
add("f20_by_lead", "band n:i " + " ".join(f"mae_{m}:f" for m in fc.METHODS) + " coverage_pct:f", lambda w: fc.by_lead(_predictions(w)), _WITH + f"(SELECT band, count(*) AS n, {_MAE}, {_COVER} FROM cm JOIN {_bands(fc.LEADS)} ON horizon BETWEEN lo AND hi GROUP BY 1))")
add("f21_by_month", "month n:i " + " ".join(f"mae_{m}:f" for m in fc.METHODS) + " coverage_pct:f", lambda w: fc.by_month(_predictions(w)), _WITH + f"(SELECT strftime(target_ts, '%Y-%m') AS month, count(*) AS n, {_MAE}, {_COVER} FROM cm WHERE horizon > 48 GROUP BY 1))")
add("f22_win_rates", "compared_with days:i better_days:i better_pct:f", lambda w: fc.win_rates(_predictions(w)),
    _WITH + "(WITH dly AS (SELECT issue, " + _MAE + " FROM cm WHERE horizon > 48 GROUP BY 1) " + " UNION ALL ".join(f"SELECT '{m}' AS compared_with, count(*) AS days, count(*) FILTER (mae_model < mae_{m}) AS better_days, 100.0 * avg(CAST(mae_model < mae_{m} AS INT)) AS better_pct FROM dly" for m in fc.METHODS[1:]) + "))")
add("q24_mae_by_horizon", "hours_ahead:f n:i " + " ".join(f"mae_{m}:f" for m in fc.METHODS), lambda w: fc.by_horizon(_predictions(w)), _WITH + f"(SELECT horizon / 2.0 AS hours_ahead, count(*) AS n, {_MAE} FROM cm GROUP BY 1))")
_TRAIN = """co AS (SELECT max(idx) AS c FROM series WHERE actual IS NOT NULL), org AS (SELECT idx, ts AS issue, 0 AS fold FROM series, co WHERE idx <= c - 96 AND idx >= greatest(672, c - 730 * 48) AND (c - 96 - idx) % 12 = 0 AND actual IS NOT NULL)"""
_WITH_TRAIN = f"(WITH full_series AS (SELECT * FROM series), {_CAL}, {_TRAIL}, {_TRAIN}, {_FEAT.replace('JOIN series v ON', 'JOIN (SELECT full_series.* FROM full_series, co WHERE idx <= c) v ON')}"


def _training(w):
    """Training rows up to the last known value."""
    series = fc.national_series(w)
    last = series.filter("actual is not null").agg(F.max("idx")).first()[0]
    return fc.training_rows(series, fc.calendar(series, w.raw.holidays), last)


add("f07_training_rows", "origin:i target:i change:f weight:f calibrates", _training,
    _WITH_TRAIN + """, rw AS (SELECT *, actual - last AS change FROM ft WHERE actual - last IS NOT NULL), hv AS (SELECT horizon, CASE WHEN var_pop(change) > 0 THEN 1 / var_pop(change) ELSE 1 END AS wt, count(*) AS n FROM rw GROUP BY 1)
    SELECT origin, target, change, wt / (SELECT sum(wt * n) / sum(n) FROM hv) AS weight, origin + 96 > (SELECT c FROM co) - 56 * 48 AS calibrates FROM rw JOIN hv USING (horizon))""")  # fmt: skip
add("f12_conformal", "lead_band:i widening:f n:i", lambda w: fc.conformal(fc.common(_predictions(w)).select("horizon", F.col("actual").alias("y"), F.col("model_p10").alias("lo"), F.col("model_p90").alias("hi"))),
    _WITH + """(SELECT lead_band, n, l[CAST(floor(p) AS INT) + 1] + (l[CAST(least(floor(p) + 1, n - 1) AS INT) + 1] - l[CAST(floor(p) AS INT) + 1]) * (p - floor(p)) AS widening FROM (
      SELECT lead_band, n, l, least(1.0, ceil((n + 1) * 0.8) / n) * (n - 1) AS p FROM (SELECT lead_band, count(*) AS n, list_sort(list(score)) AS l FROM (SELECT (horizon - 1) // 12 AS lead_band, greatest(model_p10 - actual, actual - model_p90) AS score FROM cm) GROUP BY 1))))""")  # fmt: skip
_entries_model = {"f14_next_forecast": ("origin:i horizon:i model:f model_p10:f model_p90:f", partial(fc.next_forecast, s=fc.Settings())), "f16_backtest": ("issue target_ts horizon:i actual:f model:f model_p10:f model_p90:f fold:i", partial(fc.backtest, s=fc.Settings()))}
for _name, (_spec, _plan) in _entries_model.items():
    add(_name, _spec, _plan, None)

# ---- many series in one table: every region's values, with folds and cutoffs of its own ----

_RKEY, _RETRAIN = ["region_id"], 7


def _regions(w):
    series = w._keep(fc.regional_series(w))
    return series, fc.calendar(series, w.raw.holidays, keys=_RKEY), w._keep(fc.daily_origins(series, retrain=_RETRAIN, keys=_RKEY))


def _region_features(w):
    return fc.features(*_regions(w), keys=_RKEY)


def _region_training(w):
    series, cal, origins = _regions(w)
    return fc.training_rows(series, cal, fc.cutoffs(origins, _RKEY), keys=_RKEY)


def _region_scores(w):
    series, cal, origins = _regions(w)
    rows = fc.stand_in(fc.features(series, cal, origins, keys=_RKEY))
    return fc.by_method(fc.prediction_table(rows, origins, series, _RKEY), _RKEY)


_RSERIES = """rs AS (SELECT region_id, CAST((epoch(ts) - epoch(lo)) / 1800 AS BIGINT) AS idx, ts, CAST(q.forecast AS DOUBLE) AS actual, CAST(nat.forecast AS DOUBLE) AS forecast
  FROM (SELECT region_id, lo, unnest(generate_series(lo, hi, INTERVAL 30 MINUTE)) AS ts FROM (SELECT region_id, min(ts) AS lo, max(ts) AS hi FROM rawreg GROUP BY 1)) LEFT JOIN rawreg q USING (region_id, ts) LEFT JOIN nat USING (ts))"""
_RCAL = _CAL.replace("(SELECT idx, CAST", "(SELECT region_id, idx, CAST").replace("FROM (SELECT idx, (ts", "FROM (SELECT region_id, idx, (ts").replace("FROM series UNION ALL\n  SELECT m + k", "FROM rs UNION ALL\n  SELECT region_id, m + k").replace("FROM (SELECT max(idx) AS m, max(ts) AS t FROM series)", "FROM (SELECT region_id, max(idx) AS m, max(ts) AS t FROM rs GROUP BY 1)")
_RTRAIL = _TRAIL.replace("(SELECT idx, actual AS last,", "(SELECT region_id, idx, actual AS last,").replace("FROM series", "FROM rs").replace("(ORDER BY idx", "(PARTITION BY region_id ORDER BY idx").replace("(SELECT idx, actual AS latest_slot", "(SELECT region_id, idx, actual AS latest_slot").replace("PARTITION BY idx % 48", "PARTITION BY region_id, idx % 48")
_RORIG = f"""org AS (SELECT region_id, idx, issue, (row_number() OVER (PARTITION BY region_id ORDER BY idx) - 1) // {_RETRAIN} AS fold FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY idx DESC) AS k FROM (SELECT region_id, idx, ts + INTERVAL 30 MINUTE AS issue
  FROM rs JOIN (SELECT region_id, min(ts) AS t0, max(idx) FILTER (actual IS NOT NULL) AS li FROM rs GROUP BY 1) USING (region_id) WHERE ts + INTERVAL 30 MINUTE >= date_trunc('day', t0) + INTERVAL 1 DAY AND hour(ts + INTERVAL 30 MINUTE) = 0 AND minute(ts) = 30 AND idx <= li - 96)) WHERE k <= 365)"""


def _rfeatures(origins: str) -> str:
    at = "{t}.region_id = o.region_id AND {t}.idx = o.idx"
    join = lambda t, shift: f"{at.format(t=t)}{shift}"
    return f"""ft AS (SELECT *, {_REL} FROM (SELECT o.region_id, o.idx AS origin, o.idx + h AS target, CAST(h AS DOUBLE) AS horizon, cal.* EXCLUDE (idx, region_id), tr.* EXCLUDE (idx, region_id), prof.latest_slot, prof.slot_profile, w1.actual AS back_1w, w2.actual AS back_2w, v.actual, v.forecast AS api_forecast
  FROM {origins} o CROSS JOIN range(1, 97) r(h) JOIN tr ON {join("tr", "")} JOIN cal ON {join("cal", " + h")} LEFT JOIN rs v ON {join("v", " + h")} LEFT JOIN rs w1 ON {join("w1", " + h - 336")} LEFT JOIN rs w2 ON {join("w2", " + h - 672")}
  LEFT JOIN prof ON {join("prof", " + h - CAST(ceil(h / 48.0) * 48 AS BIGINT)")}))"""


_RWITH = f"(WITH {_RSERIES}, {_RCAL}, {_RTRAIL}, {_RORIG}, {_rfeatures('org')} "
add("g01_region_features", "region_id:i origin:i target:i " + " ".join(f"{f}:f" for f in fc.FEATURES), _region_features, _RWITH + "SELECT * FROM ft)")
add("g02_region_origins", "region_id:i idx:i issue fold:i", lambda w: _regions(w)[2], f"(WITH {_RSERIES}, {_RORIG} SELECT * FROM org)")
add("g03_region_training_rows", "region_id:i fold:i origin:i target:i change:f weight:f calibrates", _region_training,
    f"""(WITH {_RSERIES}, {_RCAL}, {_RTRAIL}, {_RORIG}, co AS (SELECT region_id, fold, min(idx) AS c FROM org GROUP BY 1, 2),
    tor AS (SELECT rs.region_id, fold, c, idx FROM rs JOIN co USING (region_id) WHERE idx <= c - 96 AND idx >= greatest(672, c - 730 * 48) AND (c - 96 - idx) % 12 = 0 AND actual IS NOT NULL), {_rfeatures("(SELECT DISTINCT region_id, idx FROM tor)")},
    rw AS (SELECT ft.*, fold, c, actual - last AS change FROM ft JOIN tor ON tor.region_id = ft.region_id AND tor.idx = origin WHERE actual - last IS NOT NULL),
    hv AS (SELECT region_id, fold, horizon, CASE WHEN var_pop(change) > 0 THEN 1 / var_pop(change) ELSE 1 END AS wt, count(*) AS n FROM rw GROUP BY 1, 2, 3), sc AS (SELECT region_id, fold, sum(wt * n) / sum(n) AS mw FROM hv GROUP BY 1, 2)
    SELECT region_id, fold, origin, target, change, wt / mw AS weight, origin + 96 > c - 56 * 48 AS calibrates FROM rw JOIN hv USING (region_id, fold, horizon) JOIN sc USING (region_id, fold))""")  # fmt: skip
_RCOMMON = " AND ".join(f"{c} IS NOT NULL" for c in ("actual", *fc.METHODS, "model_p10", "model_p90"))
add("g04_region_scores", "region_id:i band method periods:i mae:f rmse:f mape_pct:f bias:f within_10_pct:f within_25_pct:f", _region_scores,
    _RWITH + f""", cm AS (SELECT * FROM (SELECT region_id, CAST(horizon AS INT) AS horizon, actual, slot_profile AS model, last AS persistence, latest_slot AS naive_yesterday, back_1w AS naive_last_week, api_forecast, slot_profile - std_24h AS model_p10, slot_profile + std_24h AS model_p90 FROM ft) WHERE {_RCOMMON})
    SELECT region_id, band, method, {ERRORS} FROM (SELECT *, value - actual AS error FROM ({' UNION ALL '.join(f"SELECT region_id, horizon, actual, '{m}' AS method, {m} AS value FROM cm" for m in fc.METHODS)})) JOIN {_bands(fc.BANDS)} ON horizon BETWEEN lo AND hi GROUP BY region_id, band, method)""")  # fmt: skip


_PAIRS = """pp AS (SELECT row_number() OVER (ORDER BY day) - 1 AS i, rule, base FROM (SELECT CAST(o_orderdate AS DATE) AS day, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) FILTER (o_orderkey % 2 = 0) AS DOUBLE) / nullif(100 * count(*) FILTER (o_orderkey % 2 = 0), 0) AS rule,
  CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / (100 * count(*)) AS base FROM orders GROUP BY 1) WHERE rule IS NOT NULL)"""
_BOOT = f"""{_PAIRS}, nn AS (SELECT count(*) AS n FROM pp), ps AS (SELECT 0 AS i, 0.0 AS r, 0.0 AS b UNION ALL SELECT i + 1, sum(rule) OVER (ORDER BY i), sum(base) OVER (ORDER BY i) FROM pp),
  bl AS (SELECT r, b, CAST('0x' || substr(md5('blocks-' || r || '-' || b), 1, 15) AS BIGINT) % (n - 6) AS s, least(7, n - b * 7) AS z FROM nn, range(2000) x(r), range(1 + CAST((SELECT count(*) FROM pp) AS BIGINT) // 7) y(b) WHERE b * 7 < n)"""
add("st1_block_starts", "r:i b:i start:i size:i", lambda w: stats.block_starts(w.raw.spark, stats.daily_pairs(w.raw).count(), 7, 2000), f"(WITH {_BOOT} SELECT r, b, s AS start, z AS size FROM bl)")
add("st2_saving_interval", "estimate:f lower:f upper:f days:i", lambda w: stats.saving_interval(stats.daily_pairs(w.raw)),
    f"""(WITH {_BOOT}, bt AS (SELECT bl.r, 100.0 * (1 - sum(p1.r - p0.r) / sum(p1.b - p0.b)) AS saving FROM bl JOIN ps p0 ON p0.i = s JOIN ps p1 ON p1.i = s + z GROUP BY 1)
    SELECT (SELECT 100.0 * (1 - avg(rule) / avg(base)) FROM pp) AS estimate, quantile_cont(saving, 0.025) AS lower, quantile_cont(saving, 0.975) AS upper, (SELECT n FROM nn) AS days FROM bt)""")  # fmt: skip
_NW = f"""{_PAIRS}, dv AS (SELECT i, rule - base AS x, rule - base - (SELECT avg(rule - base) FROM pp) AS c FROM pp), gm AS (SELECT k, sum(a.c * b.c) AS s FROM range(8) t(k), dv a, dv b WHERE b.i = a.i + k GROUP BY 1),
  nw AS (SELECT (SELECT count(*) FROM dv) AS n, (SELECT avg(x) FROM dv) AS mean, sum(CASE k WHEN 0 THEN 1.0 ELSE 2 * (1 - k / 8.0) END * s) / (SELECT count(*) FROM dv) AS variance FROM gm)"""
add("st3_newey_west", "n:i mean:f variance:f", lambda w: stats.newey_west(stats.daily_pairs(w.raw).select("i", (F.col("rule") - F.col("base")).alias("x")), 7), f"(WITH {_NW} SELECT * FROM nw)")
add("st4_diebold_mariano", "n:i mean_difference:f statistic:f p_value:f", lambda w: stats.diebold_mariano(stats.daily_pairs(w.raw).select("i", F.col("rule").alias("a"), F.col("base").alias("b"))),
    f"""(WITH {_NW}, q AS (SELECT n, mean AS mean_difference, mean / sqrt(variance / n) AS statistic FROM nw), e AS (SELECT *, abs(statistic) / sqrt(2.0) AS x, 1 / (1 + 0.3275911 * abs(statistic) / sqrt(2.0)) AS t FROM q)
    SELECT n, mean_difference, statistic, ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * exp(-x * x) AS p_value FROM e)""")  # fmt: skip


# ---- tables over the forecasts and strategies ----


def _forecast_headline(w):
    """MAE reduction against the best naive method, and the band with the lowest and highest coverage."""
    p = w._keep(_predictions(w))  # read twice
    m = fc.by_method(p).filter("band = '24-48 h'")
    model, naive = F.max(F.when(F.col("method") == "model", F.col("mae"))), F.min(F.when(F.col("method").startswith("naive") | (F.col("method") == "persistence"), F.col("mae")))
    cover = fc.interval_coverage(p).agg(F.min("coverage_pct").alias("least_coverage"), F.max("coverage_pct").alias("most_coverage"))
    return m.agg((F.lit(100.0) * (1 - model / naive)).alias("mae_reduction_pct")).crossJoin(F.broadcast(cover))


add("q17_forecast_headline", "mae_reduction_pct:f least_coverage:f most_coverage:f", _forecast_headline,
    _WITH + f"""(WITH mm AS (SELECT {_MAE} FROM cm WHERE horizon > 48), cv AS (SELECT band, {_COVER} FROM cm JOIN {_bands(fc.BANDS)} ON horizon BETWEEN lo AND hi GROUP BY 1)
    SELECT 100.0 * (1 - mae_model / least(mae_persistence, mae_naive_yesterday, mae_naive_last_week)) AS mae_reduction_pct, (SELECT min(coverage_pct) FROM cv) AS least_coverage, (SELECT max(coverage_pct) FROM cv) AS most_coverage FROM mm))""")  # fmt: skip

_RULES = ("fixed_0000", "any_start", "profile_guided", "forecast_guided", "oracle")
_BASES = ("fixed_0900", "fixed_1700")


def _interval_table(w):
    """A bootstrap interval for every rule against two fixed starts."""
    days = w._keep(numbered(w.complete_days, "day"))
    return stats.saving_intervals(days, _RULES, _BASES).withColumnsRenamed({"rule": "strategy", "base": "against"})


_ONE = """SELECT '{r}' AS strategy, '{b}' AS against, (SELECT 100.0 * (1 - avg({r}) / avg({b})) FROM fdn) AS estimate, quantile_cont(v, 0.025) AS lower, quantile_cont(v, 0.975) AS upper, (SELECT count(*) FROM fdn) AS days
  FROM (SELECT x.r, 100.0 * (1 - sum(d.{r}) / sum(d.{b})) AS v FROM bl x JOIN fdn d ON d.i >= x.s AND d.i < x.s + x.z GROUP BY 1)"""
add("q18_interval_table", "strategy against estimate:f lower:f upper:f days:i", _interval_table,
    """(WITH fdn AS (SELECT *, row_number() OVER (ORDER BY day) - 1 AS i FROM full_days), nn AS (SELECT count(*) AS n FROM fdn),
    bl AS (SELECT r, b, CAST('0x' || substr(md5('blocks-' || r || '-' || b), 1, 15) AS BIGINT) % (n - 6) AS s, least(7, n - b * 7) AS z FROM nn, range(2000) x(r), range(1000) y(b) WHERE b * 7 < n) """ + " UNION ALL ".join(_ONE.format(r=r, b=b) for r in _RULES for b in _BASES) + ")")  # fmt: skip


def _dm_table(w):
    """Diebold-Mariano tests of the model against each naive method on issue-wise MAE, in two bands."""
    daily = fc._banded(fc.common(_predictions(w)), fc.BANDS[:2]).groupBy("band", "issue").agg(*fc._maes())
    daily = w._keep(numbered(daily, "issue", ["band"]))
    others = ("persistence", "naive_yesterday", "naive_last_week")
    losses = daily.unpivot(["band", "i", "mae_model"], [f"mae_{m}" for m in others], "compared_with", "b")
    losses = losses.withColumns({"compared_with": F.substring("compared_with", 5, 99), "a": F.col("mae_model")})
    return stats.diebold_mariano(losses, 3, ["band", "compared_with"])


_DM = """SELECT '{band}' AS band, '{m}' AS compared_with, n, mean AS mean_difference, mean / sqrt(variance / n) AS statistic FROM (SELECT (SELECT count(*) FROM d{k}) AS n, (SELECT avg(mae_model - mae_{m}) FROM d{k}) AS mean,
  (SELECT sum(CASE g WHEN 0 THEN 1.0 ELSE 2 * (1 - g / 4.0) END * (a.mae_model - a.mae_{m} - c.m) * (b.mae_model - b.mae_{m} - c.m)) / (SELECT count(*) FROM d{k}) FROM range(4) t(g), d{k} a, d{k} b, (SELECT avg(mae_model - mae_{m}) AS m FROM d{k}) c WHERE b.i = a.i + g) AS variance)"""
add("q19_dm_table", "band compared_with n:i mean_difference:f statistic:f", _dm_table,
    _WITH + "(WITH " + ", ".join(f"d{k} AS (SELECT *, row_number() OVER (ORDER BY issue) - 1 AS i FROM (SELECT issue, {_MAE} FROM cm WHERE horizon BETWEEN {lo} AND {hi} GROUP BY 1))" for k, (_, lo, hi) in enumerate(fc.BANDS[:2]))
    + " " + " UNION ALL ".join(_DM.format(band=b, m=m, k=k) for k, (b, _, _) in enumerate(fc.BANDS[:2]) for m in ("persistence", "naive_yesterday", "naive_last_week")) + "))")


# ---- validation runs ----

_RUNS = {"2024-04-04 00:00:00": "a week earlier", "2024-04-08 00:00:00": "three days earlier"}  # settings name what a run was made with


def _profile_model(series, cal, origins):
    return fc.stand_in(fc.features(series, cal, origins))


def _compared_runs(w):
    """Backtests of the series as it was at two times, stored and compared."""
    path = feeds.shared(w.raw.spark)
    for until, settings in _RUNS.items():
        fc.validation_run(w, until, path, _profile_model, settings)
    return sinks.compare_runs(w.raw.spark.read.parquet(f"{path}/by_method"))


_RUN = "SELECT '{u}' AS cutoff, '{s}' AS settings, {m} FROM (WITH whole AS (SELECT * FROM series), series AS (SELECT * FROM whole WHERE ts < TIMESTAMP '{u}'), " + f"{_CAL}, {_TRAIL}, {_ORIG}, {_FEAT}, {_PRED} SELECT * FROM cm WHERE horizon > 48)"
_RUN_MAE = ", ".join(f"avg(abs({m} - actual)) AS {m}" for m in fc.METHODS)
add("q20_compare_runs", "cutoff settings " + " ".join(f"{m}:f" for m in fc.METHODS), _compared_runs, "(" + " UNION ALL ".join(_RUN.format(u=u, s=s, m=_RUN_MAE) for u, s in _RUNS.items()) + ")")


def _stored_predictions(w):
    """A stored run's rows come back with the cutoff and settings that they belong to, and only from before the cutoff."""
    path, until = feeds.shared(w.raw.spark), next(iter(_RUNS))
    fc.validation_run(w, until, path, _profile_model, _RUNS[until])
    rows = w.raw.spark.read.parquet(f"{path}/predictions")
    return rows.groupBy("cutoff", "settings", "horizon").agg(F.count(F.lit(1)).alias("n"), F.max("target_ts").alias("last_target"), F.sum("actual").alias("total"))


add("f23_validation_run", "cutoff settings horizon:i n:i last_target total:f", _stored_predictions,
    "(" + _RUN.format(u=next(iter(_RUNS)), s=_RUNS[next(iter(_RUNS))], m="horizon, count(*) AS n, max(target_ts) AS last_target, sum(actual) AS total").replace("FROM cm WHERE horizon > 48", "FROM pr") + " GROUP BY horizon)")
