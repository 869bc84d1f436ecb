"""Spine, windows, calendars, savings, intervals and upserts on small hand-made inputs."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tideline.functions import timefn as fn
from tideline.operators import intervals, quality, series, upsert
from tideline.plans import forecasting as fc
from tideline.plans import stats
from tideline.plans.warehouse import Params, Warehouse, savings_of
from tideline.sources import readers, sinks


def ts(text):
    return dt.datetime.fromisoformat(text)


class Given:
    """Raw datasets made by hand."""

    def __init__(self, spark, national):
        self.spark = spark
        self.national = spark.createDataFrame(national, "ts timestamp_ntz, forecast int, actual int, band string")
        self.holidays = spark.createDataFrame([(dt.date(2026, 1, 1), "New Year"), (dt.date(2026, 1, 1), "Another name")], "day date, name string")


def test_spine_fills_and_flags(spark):
    w = Warehouse(Given(spark, [(ts("2026-01-05T00:00"), 100, 110, "low"), (ts("2026-01-05T01:00"), 5, 0, "low")]))
    rows = [tuple(r) for r in w.half_hours.orderBy("ts").select("forecast", "actual", "is_missing", "is_forecast_implausible", "is_actual_implausible", "is_actual_missing").collect()]
    assert rows == [(100, 110, False, False, False, False), (None, None, True, False, False, True), (None, None, False, True, True, True)]


def test_spring_change_skips_slots(spark):
    times = [(ts("2026-03-29T00:00") + dt.timedelta(minutes=30 * k),) for k in range(4)]
    out = spark.createDataFrame(times, "ts timestamp_ntz").orderBy("ts").select(fn.slot(fn.to_local("ts")).alias("s"))
    assert [r.s for r in out.collect()] == [0, 1, 4, 5]


def test_incomplete_windows_are_dropped(spark):
    rows = [(ts("2026-01-05T00:00"), 100, 100, "low"), (ts("2026-01-05T00:30"), 200, 200, "low"), (ts("2026-01-05T01:00"), 300, None, "low")]
    w = Warehouse(Given(spark, rows), Params(job_hours=1))
    assert [(r.time_key, r.job_actual, r.job_forecast) for r in w.job_windows.collect()] == [(0, 150.0, 150.0)]


def test_rolling_equals_one_window(spark):
    from pyspark.sql import Window

    df = spark.range(1000).select(F.col("id").alias("idx"), F.when(F.col("id") % 7 != 0, F.col("id") * 1.5).alias("x"))
    got = series.rolling(df, [], "idx", 5, 3, {"m": F.avg("x"), "n": F.count("x")}, chunk=64)
    w = Window.orderBy("idx").rowsBetween(-5, 3)
    want = df.withColumns({"m": F.avg("x").over(w), "n": F.count("x").over(w)})
    assert got.exceptAll(want).isEmpty() and got.count() == 1000


def test_ties_go_to_the_earliest_slot(spark):
    rows = []
    for day in range(40):
        for slot in range(48):
            t = ts("2026-01-01T00:00") + dt.timedelta(days=day, minutes=30 * slot)
            rows.append((t, t, t.date(), int(t.strftime("%Y%m%d")), slot, *([50.0 if slot in (10, 20) else 100.0 + slot] * 2)))
    random.Random(1).shuffle(rows)
    w = Warehouse(Given(spark, [(ts("2026-01-01T00:00"), 100, 100, "low"), (ts("2026-02-09T23:30"), 100, 100, "low")]), Params(window=("2026-01-01", "2026-02-09")))
    w.job_windows = spark.createDataFrame(rows, "ts timestamp_ntz, local_ts timestamp_ntz, day date, date_key int, time_key int, job_actual double, job_forecast double")
    out = w.daily_strategies.collect()
    assert len(out) == 40
    assert {(r.forecast_time_key, r.oracle_time_key, r.forecast_guided, r.oracle) for r in out} == {(10, 10, 50.0, 50.0)}
    later = [r for r in out if r.profile_guided is not None]
    assert later and {(r.profile_time_key, r.profile_guided) for r in later} == {(10, 50.0)}


def test_last_known_offset(spark):
    out = spark.createDataFrame([(1,), (48,), (49,), (96,)], "h int").select(fn.last_known_offset(F.col("h")).alias("o"))
    assert [r.o for r in out.collect()] == [48, 48, 96, 96]


def test_newey_west(spark):
    """Against sums of products, over all lags up to four and for two keys at once."""
    rng = random.Random(11)
    rows = [(k, i, rng.gauss(2, 1) + i % 5) for k, n in (("a", 23), ("b", 9)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i long, x double")
    for lags in range(5):
        for r in stats.newey_west(df, lags, ["k"]).collect():
            x = [v for k, _, v in rows if k == r.k]
            mean = sum(x) / len(x)
            covariance = lambda lag: sum((x[i] - mean) * (x[i + lag] - mean) for i in range(len(x) - lag)) / len(x)  # noqa: B023, E731
            assert r.variance == pytest.approx(covariance(0) + 2 * sum((1 - j / (lags + 1)) * covariance(j) for j in range(1, lags + 1)))


def test_diebold_mariano_is_undefined_without_variation(spark):
    losses = [(i, 1.0, 1.0) for i in range(20)]
    assert stats.diebold_mariano(spark.createDataFrame(losses, "i long, a double, b double")).first().statistic is None


def test_common_sample(spark):
    base = dict(actual=100.0, model=101.0, persistence=90.0, naive_yesterday=80.0, naive_last_week=70.0, api_forecast=99.0, model_p10=95.0, model_p90=105.0, fold=0)
    rows = [{"issue": ts("2026-01-01T00:00"), "target_ts": ts("2026-01-01T00:00"), "horizon": 1, **base}, {"issue": ts("2026-01-01T00:00"), "target_ts": ts("2026-01-01T00:30"), "horizon": 2, **base, "naive_last_week": None}]
    schema = "issue timestamp_ntz, target_ts timestamp_ntz, horizon int, actual double, model double, persistence double, naive_yesterday double, naive_last_week double, api_forecast double, model_p10 double, model_p90 double, fold int"
    p = spark.createDataFrame([[r[c.split()[0]] for c in schema.split(", ")] for r in rows], schema)
    assert {r.periods for r in fc.by_method(p).collect()} == {1}
    assert [(r.band, r.n, r.coverage_pct) for r in fc.by_lead(p).collect()] == [("0-1 h", 1, 100.0)]


HOLIDAYS = "day date, name string"


def test_features_see_nothing_after_the_origin(spark):
    s = half_hours(spark, 20)
    corrupt = s.withColumn("actual", F.when(F.col("idx") > 800, F.lit(1e6)).otherwise(F.col("actual")))
    holidays = spark.createDataFrame([], HOLIDAYS)
    origin = s.filter("idx = 800").select("idx")
    a, b = (fc.features(x, fc.calendar(x, holidays), origin).drop("actual") for x in (s, corrupt))
    assert a.count() == 96 and a.exceptAll(b).isEmpty()


def test_pinned_origin(spark):
    """Issued at six o'clock, the last three before a pinned evening; a pin whose two days aren't observed is refused."""
    s = half_hours(spark, 17)
    out = fc.daily_origins(s, 3, 6, 2, "2025-01-11 21:30:00").orderBy("idx").collect()
    assert [(r.issue, r.fold) for r in out] == [(ts("2025-01-09T06:00"), 0), (ts("2025-01-10T06:00"), 0), (ts("2025-01-11T06:00"), 1)]
    assert all(r.idx == (r.issue - ts("2025-01-01T00:00")) // dt.timedelta(minutes=30) - 1 for r in out)
    with pytest.raises(ValueError):
        fc.daily_origins(s, 3, 6, 2, "2025-01-17 21:30:00")


def test_horizons_weigh_alike(spark):
    s = half_hours(spark, 30)
    rows = fc.training_rows(s, fc.calendar(s, spark.createDataFrame([], HOLIDAYS)), 1300, fc.Settings())
    parts = [r.v for r in rows.groupBy("horizon").agg((F.var_pop("change") * F.avg("weight")).alias("v")).collect()]
    assert max(parts) / min(parts) == pytest.approx(1, rel=1e-6)
    assert rows.agg(F.avg("weight")).first()[0] == pytest.approx(1)


def test_intervals(spark):
    t = lambda x: ts(f"2026-01-0{x}T00:00")
    df = spark.createDataFrame([("a", t(1), t(2)), ("a", t(2), t(3)), ("a", t(5), t(6)), ("b", t(1), t(4)), ("b", t(2), t(3))], "k string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    assert sorted(map(tuple, intervals.merge(df, ["k"]).collect())) == [("a", t(1), t(3)), ("a", t(5), t(6)), ("b", t(1), t(4))]


def test_chunks_cover_and_stop_at_the_year(spark):
    df = spark.createDataFrame([(ts("2025-11-20T00:00"), ts("2026-01-20T00:00"))], "start_ts timestamp_ntz, end_ts timestamp_ntz")
    out = sorted(map(tuple, intervals.chunks(df, [], 30).collect()))
    assert out[0][0] == ts("2025-11-20T00:00") and out[-1][1] == ts("2026-01-20T00:00")
    assert all(a[1] == b[0] for a, b in zip(out, out[1:]))
    assert all(b - a <= dt.timedelta(days=30) for a, b in out)
    assert ts("2025-12-31T23:30") in {a for a, _ in out}


def test_to_fetch(spark):
    rows = [("new", None, None), ("old", ts("2026-01-10T00:00"), ts("2026-01-19T23:30"))]
    out = intervals.to_fetch(spark.createDataFrame(rows, "k string, lo timestamp_ntz, hi timestamp_ntz"), ["k"], "2026-01-01 00:00:00", "2026-01-20 00:00:00")
    assert sorted(map(tuple, out.collect())) == [("new", ts("2026-01-01T00:00"), ts("2026-01-20T00:00")), ("old", ts("2026-01-01T00:00"), ts("2026-01-10T00:00")), ("old", ts("2026-01-18T00:00"), ts("2026-01-20T00:00"))]


def test_upsert(spark, tmp_path):
    schema, path = "ts timestamp_ntz, value int, fetched_at string, n int", str(tmp_path / "table")
    put = lambda *rows: upsert.upsert(spark, path, spark.createDataFrame(rows, schema), ["ts"], "ts", ["fetched_at"], "n")
    a, b, c = ts("2026-01-01T00:00"), ts("2026-01-01T00:30"), ts("2026-02-01T00:00")
    assert put((a, 1, "x", 0), (b, None, "x", 0), (c, 3, "x", 0)) == {"inserted": 3, "updated": 0, "unchanged": 0, "months": ["2026-01", "2026-02"]}
    assert put((a, 1, "later", 0), (b, None, "later", 0)) == {"inserted": 0, "updated": 0, "unchanged": 2, "months": []}
    assert put((b, 5, "y", 0), (b, 7, "y", 1)) == {"inserted": 0, "updated": 1, "unchanged": 0, "months": ["2026-01"]}
    assert sorted((r.ts, r.value) for r in upsert.rows_of(spark, path).collect()) == [(a, 1), (b, 7), (c, 3)]
    with pytest.raises(ValueError):
        put((None, 1, "x", 0))


def test_manifest_finds_corruption(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"one")
    (tmp_path / "b.bin").write_bytes(b"two")
    before = spark.createDataFrame(upsert.file_manifest(spark, str(tmp_path)).collect())
    assert upsert.corrupt_files(before, upsert.file_manifest(spark, str(tmp_path))).isEmpty()
    (tmp_path / "b.bin").write_bytes(b"tw0")
    now = upsert.file_manifest(spark, str(tmp_path))
    assert [r.path[-5:] for r in upsert.corrupt_files(before, now).collect()] == ["b.bin"] == [r.path[-5:] for r in upsert.changed_files(before, now).collect()]


def test_strict_csv(spark, tmp_path):
    columns = {"Area": ("area", "string"), "Year": ("year", "int"), "EU": ("is_eu", "boolean"), "TWh": ("twh", "double")}
    good = tmp_path / "good.csv"
    good.write_text("Area,Year,EU,TWh\nB,2020,true,1.5\n A ,2021,False,\n")
    assert [tuple(r) for r in readers.strict_csv(spark, str(good), columns, ["area", "year"]).collect()] == [("A", 2021, False, None), ("B", 2020, True, 1.5)]
    for text in ("Area,Year,EU\nA,1,true\n", "Area,Year,EU,TWh\n", "Area,Year,EU,TWh\n,2020,true,1\n", "Area,Year,EU,TWh\nA,x,true,1\n"):
        bad = tmp_path / f"bad{abs(hash(text))}.csv"
        bad.write_text(text)
        with pytest.raises(Exception):  # noqa: B017
            readers.strict_csv(spark, str(bad), columns, ["area", "year"]).collect()


def test_json_problems(spark):
    level = '"intensity":{"forecast":1,"actual":null,"index":"low"}'
    bodies = [
        '{"error":{"code":"400","message":"x"}}', "{}", f'{{"data":[{{"from":"2026-01-01T00:00Z","to":"2026-01-01T00:30Z",{level}}}]}}',
        f'{{"data":[{{"from":"2026-01-01T00:00Z","to":"2026-01-01T01:00Z",{level}}}]}}', f'{{"data":[{{"from":"2026-01-01 00:00","to":"2026-01-01T00:30Z",{level}}}]}}',
        '{"data":[{"from":"2026-01-01T00:00Z","to":"2026-01-01T00:30Z","intensity":{"forecast":"many","index":"odd"}}]}',
        '{"data":[{"from":"2026-01-01T00:00Z","to":"2026-01-01T00:30Z","generationmix":[{"fuel":"GAS","perc":"x"}]}]}',
    ]
    rows = readers.periods(spark.createDataFrame(list(enumerate(bodies)), "i int, body string"))
    assert {r.i: r.problems for r in rows.collect()} == {0: ["error_document"], 1: ["no_data"], 2: [], 3: ["not_half_hour"], 4: ["bad_time"], 5: ["bad_number", "bad_index"], 6: ["bad_share"]}
    assert readers.good(rows, "quarantine").count() == 1
    with pytest.raises(Exception):  # noqa: B017
        readers.good(rows).collect()


def test_checks_find_seeded_defects(spark):
    df = spark.createDataFrame([(1, 5, ts("2026-01-01T00:00")), (1, 500, ts("2026-01-01T00:10")), (2, None, ts("2026-01-01T02:00"))], "k int, v int, ts timestamp_ntz")
    parent = spark.createDataFrame([(1,)], "k int")
    assert quality.accepted_range(df, "v", 0, 100).count() == 1
    assert quality.aligned(df, "ts").count() == 1
    assert quality.unique(df, ["k"]).count() == 1
    assert quality.not_null(df, "v").count() == 1
    assert quality.foreign_key(df, "k", parent, "k").count() == 1
    assert quality.accepted_values(df, "k", [1]).count() == 1
    suite = quality.run_suite([quality.Check("range", quality.accepted_range(df, "v", 0, 100), 1, 5), quality.Check("unique", quality.unique(df, ["k"])), quality.Check("ok", quality.accepted_range(df, "k", 0, 9))])
    assert {(r.check_name, r.failures, r.status) for r in suite.collect()} == {("range", 1, "warn"), ("unique", 1, "error"), ("ok", 0, "pass")}


def test_csv_export_counts(spark, tmp_path):
    manifest = sinks.export_star(spark, {"t": (spark.range(5), ["id"]), "u": (spark.range(2), ["id"])}, str(tmp_path / "star"))
    assert {tuple(r) for r in manifest.collect()} == {("t", 5), ("u", 2)}
    assert spark.read.option("header", True).csv(str(tmp_path / "star/t")).count() == 5


def test_plan_has_a_limit_for_each_dataset(spark):
    rows = [("national", ts("2026-01-01T00:00"), ts("2026-02-10T00:00")), ("regional", ts("2026-01-01T00:00"), ts("2026-01-20T00:00"))]
    df = spark.createDataFrame(rows, "dataset string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    out = intervals.plan(df, [], "dataset", {"national": 30, "regional": 13})
    assert {r.dataset: r["count"] for r in out.groupBy("dataset").count().collect()} == {"national": 2, "regional": 2}
    with pytest.raises(ValueError):
        intervals.plan(df, [], "dataset", {"national": 30})


def test_the_hour_that_comes_twice(spark):
    """Both clock hours of an autumn night keep their own UTC rows under one local slot and date."""
    rows = [(ts("2023-10-29T00:00") + dt.timedelta(minutes=30 * k), 50, 60 + k, "low") for k in range(4)]
    w = Warehouse(Given(spark, rows))
    out = w.half_hours.orderBy("ts").select("date_key", "time_key", "actual").collect()
    assert [tuple(r) for r in out] == [(20231029, 2, 60), (20231029, 3, 61), (20231029, 2, 62), (20231029, 3, 63)]


def test_savings_are_taken_over_complete_days_only(spark):
    """Three days of which the second lacks a profile; 8 hours at 250 kW."""
    names = ("fixed_0000", "fixed_0900", "fixed_1700", "any_start", "profile_guided", "forecast_guided", "oracle")
    days = [(dt.date(2022, 5, 1), 90.0, 300.0, 240.0, 210.0, 120.0, 150.0, 60.0), (dt.date(2022, 5, 2), 1.0, 1.0, 1.0, 1.0, None, 1.0, 1.0), (dt.date(2022, 5, 3), 110.0, 500.0, 160.0, 190.0, 200.0, 50.0, 40.0)]
    df = spark.createDataFrame(days, "day date, " + ", ".join(f"{n} double" for n in names))
    out = {r.strategy: r for r in savings_of(df.dropna(subset=["profile_guided", "forecast_guided"]), Params(job_hours=8, job_kw=250)).collect()}
    for n in names:
        mean = (days[0][1 + names.index(n)] + days[2][1 + names.index(n)]) / 2
        row = out[n]
        assert (row.days, row.mean_job, row.kg_per_run) == (2, mean, mean * 2)
        assert row.saving_0900_pct == pytest.approx(100 * (400 - mean) / 400) and row.saving_0000 == 100 - mean


def test_bootstrap_against_whole_resamples(spark):
    """Block sums by running sums are those of the resampled rows themselves."""
    rng = random.Random(8)
    pairs = [(i, rng.uniform(1, 9), rng.uniform(10, 20)) for i in range(23)]
    got = stats.saving_interval(spark.createDataFrame(pairs, "i long, rule double, base double"), 5, 60).first()
    drawn = {}
    for r in stats.block_starts(spark, 23, 5, 60).collect():
        drawn.setdefault(r.r, []).extend(range(r.start, r.start + r.size))
    assert all(len(x) == 23 for x in drawn.values())
    savings = sorted(100 * (1 - sum(pairs[i][1] for i in x) / sum(pairs[i][2] for i in x)) for x in drawn.values())
    at = 0.025 * 59
    assert got.lower == pytest.approx(savings[1] + (savings[2] - savings[1]) * (at - 1))
    assert got.estimate == pytest.approx(100 * (1 - sum(p[1] for p in pairs) / sum(p[2] for p in pairs)))


def half_hours(spark, days):
    """A tent over the day, lower at weekends, with a rough edge that repeats every 101 half-hours."""
    rows = []
    for k in range(48 * days):
        a = 220.0 - 5 * abs(k % 48 - 31) - (25 if k // 48 % 7 > 4 else 0) + k * 7919 % 101 / 12
        rows.append((k, ts("2025-01-01T00:00") + dt.timedelta(minutes=30 * k), a, a + k * 104729 % 13 - 6))
    return spark.createDataFrame(rows, "idx long, ts timestamp_ntz, actual double, forecast double")


def test_fitted_forecasts_beat_the_last_value(spark):
    s = half_hours(spark, 40).cache()
    cal = fc.calendar(s, spark.createDataFrame([], HOLIDAYS))
    origin = s.filter("idx in (1700, 1748, 1796)").select("idx")
    settings = fc.Settings(calibration_days=6, trees=8, depth=4, rate=0.3, bound_trees=3)
    model = fc.Forecaster(settings).fit(fc.training_rows(s, cal, 1690, settings))
    out = fc.baselines(model.predict(fc.features(s, cal, origin))).agg(F.avg(F.abs(F.col("model") - F.col("actual"))).alias("m"), F.avg(F.abs(F.col("persistence") - F.col("actual"))).alias("p"), F.min((F.col("model_p10") <= F.col("model")) & (F.col("model") <= F.col("model_p90"))).alias("ordered")).first()
    assert out.m < 0.7 * out.p and out.ordered


def test_conformal_is_the_interpolated_order_statistic(spark):
    rng = random.Random(5)
    rows = [(h, rng.gauss(0, 9), -4.0, 5.0) for h in (1, 12, 13, 24) for _ in range(rng.randint(3, 40))]
    got = {r.lead_band: (r.widening, r.n) for r in fc.conformal(spark.createDataFrame(rows, "horizon int, y double, lo double, hi double")).collect()}
    for band in (0, 1):
        scores = sorted(max(lo - y, y - hi) for h, y, lo, hi in rows if (h - 1) // 12 == band)
        n = len(scores)
        at = min(1.0, -(-(n + 1) * 8 // 10) / n) * (n - 1)
        below = int(at)
        want = scores[below] + (scores[min(below + 1, n - 1)] - scores[below]) * (at - below)
        assert got[band] == (pytest.approx(want), n)


def test_a_backtest_has_enough_to_train_on(spark):
    s = fc.Settings()
    series = half_hours(spark, 30)
    first = fc.first_cutoff(s)
    least = {r.idx for r in fc.daily_origins(series, least=first).collect()}
    assert least and min(least) >= first and least < {r.idx for r in fc.daily_origins(series).collect()}
    cal = fc.calendar(series, spark.createDataFrame([], HOLIDAYS))
    assert fc.training_rows(series, cal, min(least), s).count() >= s.least_rows > fc.training_rows(series, cal, first - 2 * s.origin_step, s).count()


def test_snapshots_are_stamped_with_the_half_hour(spark):
    rows = spark.createDataFrame([(7,), (8,)], "forecast int")
    clock = F.lit("2024-02-29 23:59:00").cast("timestamp_ntz")
    stamped = readers.issued_now(rows, "2024-02-29 23:41:12", clock).collect()
    assert {(r.forecast, r.issued) for r in stamped} == {(7, ts("2024-02-29T23:30")), (8, ts("2024-02-29T23:30"))}
    assert readers.issued_now(rows, "2024-02-29 23:28:59", clock).count() == 0


def scattered(seed, many, span):
    rng = random.Random(seed)
    return sorted({ts("2024-01-15T00:00") + dt.timedelta(minutes=30 * rng.randrange(span)) for _ in range(many)})


def test_following_and_numbering_go_through_months(spark):
    times = scattered(1, 300, 48 * 200)  # several months, some of them nearly empty
    rows = [("a", t) for t in times] + [("b", t) for t in times[::50]] + [("c", times[0])]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz").repartition(3)
    got = {(r.k, r.ts): r.next_ts for r in series.following(df, ["k"], "ts").collect()}
    for k in "abc":
        mine = [t for name, t in rows if name == k]
        assert [got[k, t] for t in mine] == mine[1:] + [None]
    one = df.filter("k = 'a'").select("ts")
    assert {r.ts: r.i for r in series.numbered(one, "ts").collect()} == {t: i for i, t in enumerate(times)}
    assert series.regular(one, [], "ts").count() == sum(b - a != dt.timedelta(minutes=30) for a, b in zip(times, times[1:]))


def test_running_sums_go_through_chunks(spark):
    df = spark.range(500).select(F.col("id").alias("i"), (F.col("id") % 7).cast("double").alias("x"))
    got = {r.i: r.x for r in series.running_sums(df, "i", ["x"], chunk=64).collect()}
    total = 0
    for i in range(500):
        total += i % 7
        assert got[i] == total


def test_spine_is_made_in_chunks(spark):
    df = spark.createDataFrame([("a", ts("2024-03-01T00:00")), ("a", ts("2024-03-05T10:30")), ("b", ts("2024-03-01T00:30"))], "k string, ts timestamp_ntz")
    for chunk in (1, 7, 48, 5000):
        out = [tuple(r) for r in series.spine(df, ["k"], "ts", chunk).orderBy("k", "ts").collect()]
        assert out == [("a", ts("2024-03-01T00:00") + dt.timedelta(minutes=30 * i)) for i in range(214)] + [("b", ts("2024-03-01T00:30"))]


def test_merging_across_months(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(80):
        a = ts("2024-01-20T00:00") + dt.timedelta(hours=rng.randrange(24 * 150))
        rows.append((rng.choice("xy"), a, a + dt.timedelta(hours=rng.choice((1, 5, 24, 24 * 45)))))
    df = spark.createDataFrame(rows, "k string, start_ts timestamp_ntz, end_ts timestamp_ntz").repartition(3)

    def merged(spans):
        out = []
        for a, b in sorted(spans):
            if out and a <= out[-1][1]:
                out[-1][1] = max(out[-1][1], b)
            else:
                out.append([a, b])
        return sorted(map(tuple, out))

    assert sorted(map(tuple, intervals.merge(df, []).select("start_ts", "end_ts").collect())) == merged([r[1:] for r in rows])
    for k in "xy":
        assert sorted((r.start_ts, r.end_ts) for r in intervals.merge(df, ["k"]).filter(F.col("k") == k).collect()) == merged([r[1:] for r in rows if r[0] == k])


def test_known_gaps_excuse_their_own_dataset_only(spark):
    day = lambda d, h: ts(f"2024-05-{d:02d}T{h:02d}:00")
    df = spark.createDataFrame([(1, day(1, 0)), (1, day(3, 5)), (1, day(9, 0))], "k int, ts timestamp_ntz")
    known = spark.createDataFrame([("mine", day(1, 0), day(4, 0)), ("other", day(3, 0), day(10, 0)), ("mine", day(5, 0), day(10, 0))], "dataset string, start_ts timestamp_ntz, end_ts timestamp_ntz")
    assert [r.start_ts for r in quality.unexpected_gaps(df, ["k"], "ts", known, "mine").collect()] == [ts("2024-05-03T05:30")]
    assert quality.unexpected_gaps(df, ["k"], "ts", known.filter("false"), "mine").count() == 2


def test_rules_of_rows_take_one_scan(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "b"), (9, "a")], "v int, s string")
    rules = [quality.Rule("small", F.col("v") < 5), quality.Rule("named", F.col("s").isNotNull(), F.col("v") > 1, 1, 2), quality.Rule("any", F.lit(True))]
    assert {tuple(r) for r in quality.check_rows(df, rules).collect()} == {("small", 1, "error"), ("named", 1, "warn"), ("any", 0, "pass")}


def test_restore_stops_on_a_damaged_file(spark, tmp_path):
    published, table = str(tmp_path / "published"), str(tmp_path / "table")
    rows = [(ts("2024-06-01T00:00") + dt.timedelta(hours=k), k) for k in range(50)]
    spark.createDataFrame(rows, "ts timestamp_ntz, v int").repartition(3).write.parquet(published)
    manifest = spark.createDataFrame(upsert.file_manifest(spark, published, rows=True).collect())
    again = lambda m: upsert.restore(spark, m, published, table, ["ts"], "ts")
    assert again(manifest)["inserted"] == 50 and again(manifest)["unchanged"] == 50
    for wrong in (manifest.filter("false"), manifest.withColumn("rows", F.col("rows") + 1)):
        with pytest.raises(ValueError):
            again(wrong)
    damaged = next((tmp_path / "published").glob("*.parquet"))
    damaged.write_bytes(damaged.read_bytes()[:-1] + b"x")
    (damaged.parent / f".{damaged.name}.crc").unlink()  # as in a store without checksums of its own
    with pytest.raises(ValueError, match="manifest"):
        upsert.restore(spark, manifest, published, str(tmp_path / "elsewhere"), ["ts"], "ts")
    assert not (tmp_path / "elsewhere").exists()


def test_refresh_keeps_the_last_good_copy(spark, tmp_path):
    table, landed = str(tmp_path / "table"), tmp_path / "yearly.csv"
    read = lambda path: readers.strict_csv(spark, path, {"Area": ("area", "string"), "Year": ("year", "int")}, ["area", "year"])
    landed.write_text("Area,Year\n")
    with pytest.raises(ValueError):
        upsert.refresh(spark, str(landed), table, read)  # bad, and nothing to keep
    said = []
    for text in ("Area,Year\nA,2001\n", "Area,Year\nA,2001\n", "Area\nA\n", "Area,Year\nB,soon\n", "Area,Year\nC,2003\nC,2004\n"):
        landed.write_text(text)
        said.append(upsert.refresh(spark, str(landed), table, read))
    assert said == ["replaced", "unchanged", "kept", "kept", "replaced"]
    assert sorted((r.area, r.year) for r in upsert.current(spark, table).collect()) == [("C", 2003), ("C", 2004)]


def test_runs_are_stored_and_compared(spark, tmp_path):
    scores = spark.createDataFrame([("24-48 h", "model", 4.0), ("24-48 h", "persistence", 6.0), ("0-24 h", "model", 1.0)], "band string, method string, mae double")
    for cutoff, more in (("2024-01-01", 0), ("2024-02-01", 10)):
        sinks.write_run(scores, {"by_method": scores.withColumn("mae", F.col("mae") + more)}, str(tmp_path), cutoff, "small")
    out = sinks.compare_runs(spark.read.parquet(f"{tmp_path}/by_method")).orderBy("cutoff").collect()
    assert [(r.cutoff, r.model, r.persistence, r.naive_yesterday) for r in out] == [("2024-01-01", 4.0, 6.0, None), ("2024-02-01", 14.0, 16.0, None)]


def test_conform_takes_the_schema_exactly(spark):
    df = spark.createDataFrame([("1", "2024-01-01 00:00:00")], "n string, ts string")
    out = upsert.conform(df.select("ts", "n"), readers.Dataset("n int, ts timestamp_ntz", ("ts",), "ts").struct())
    assert out.dtypes == [("n", "int"), ("ts", "timestamp_ntz")] and out.first().n == 1
    for wrong in (df.drop("n"), df.withColumn("more", F.lit(1))):
        with pytest.raises(ValueError):
            upsert.conform(wrong, out.schema)


def test_ceiling_and_floor_of_half_hours(spark):
    times = ["2024-01-01T00:00:00", "2024-01-01T00:00:00.000001", "2024-01-01T00:29:59.999999", "2024-01-01T00:30:00", "2023-12-31T23:31:07"]
    out = spark.createDataFrame([(ts(t),) for t in times], "ts timestamp_ntz").select(fn.floor_half_hour("ts").alias("a"), fn.ceil_half_hour("ts").alias("b")).collect()
    show = lambda t: t.strftime("%d %H:%M")
    assert [(show(r.a), show(r.b)) for r in out] == [("01 00:00", "01 00:00"), ("01 00:00", "01 00:30"), ("01 00:00", "01 00:30"), ("01 00:30", "01 00:30"), ("31 23:30", "01 00:00")]
