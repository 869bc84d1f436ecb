"""Names, columns and SQL of sources, sinks, reshaping and streams."""

import re

from pyspark.sql import functions as F

from ..functions import timefn as fn
from ..operators import series as ops
from ..operators import upsert as up
from ..operators import versions
from ..sources import readers, sinks
from ..streaming import feeds
from . import adhoc, forecasting
from .catalog import add



def _national_documents(w):
    level = F.struct("forecast", "actual", F.col("band").alias("index")).alias("intensity")
    return readers.landed(w.raw.national.select("ts", level), F.to_date("ts"))


def _mix_documents(w):
    shares = w.raw.mix.groupBy("ts").agg(F.sort_array(F.collect_list(F.struct("fuel", F.col("share").alias("perc")))).alias("generationmix"))
    return readers.landed(shares, F.to_date("ts"))


def _regional_documents(w):
    mix = w.raw.regional_mix.groupBy("ts", "region_id").agg(F.sort_array(F.collect_list(F.struct("fuel", F.col("share").alias("perc")))).alias("generationmix"))
    rows = w.raw.regional.join(mix, ["ts", "region_id"])
    region = F.struct(F.col("region_id").alias("regionid"), F.format_string("Region %d", "region_id").alias("shortname"), F.struct("forecast", F.col("band").alias("index")).alias("intensity"), "generationmix")
    return readers.landed(rows.groupBy("ts").agg(F.sort_array(F.collect_list(region)).alias("regions")), F.to_date("ts"))


add("src04_national_json", "ts end_ts forecast:i actual:i band", lambda w: readers.national_rows(readers.good(readers.periods(_national_documents(w)))), "(SELECT *, ts + INTERVAL 30 MINUTE AS end_ts FROM nat)")
add("src05_mix_json", "ts end_ts fuel share:f", lambda w: readers.mix_rows(readers.good(readers.periods(_mix_documents(w)))), "(SELECT *, ts + INTERVAL 30 MINUTE AS end_ts FROM rawmix)")
add("src06_regional_json", "ts region_id:i forecast:i band", lambda w: readers.regional_rows(readers.good(readers.periods(_regional_documents(w))))[0], "rawreg")
add("src06_regional_mix_json", "ts region_id:i fuel share:f", lambda w: readers.regional_rows(readers.good(readers.periods(_regional_documents(w))))[1], "rawregmix")
add("src07_snapshot_json", "issued ts forecast:i", lambda w: readers.snapshot_rows(readers.good(readers.periods(_national_documents(w))), F.lit("2024-04-10 09:30:00").cast("timestamp_ntz")),
    "(SELECT TIMESTAMP '2024-04-10 09:30:00' AS issued, ts, forecast FROM nat)")
add("src08_quarantine", "problem n:i", lambda w: readers.periods(_national_documents(w).withColumn("body", F.replace("body", F.lit('"index":"very low"'), F.lit('"index":"tiny"')))).select(F.explode("problems").alias("problem")).groupBy("problem").agg(F.count(F.lit(1)).alias("n")),
    "(SELECT 'bad_index' AS problem, count(*) AS n FROM nat WHERE band = 'very low' HAVING count(*) > 0)")
add("src09_clip", "ts actual:i", lambda w: readers.clip(w.raw.national, "ts", "2024-03-20 00:00:00", "2024-03-22 00:00:00"), "nat WHERE ts >= TIMESTAMP '2024-03-20' AND ts < TIMESTAMP '2024-03-22'")
add("src13_slots", "time_key:i n:i", lambda w: w.raw.spark.range(48).select(F.col("id").alias("time_key")).join(w.raw.national.groupBy(fn.slot("ts").alias("time_key")).agg(F.count(F.lit(1)).alias("n")), "time_key", "left"),
    "(SELECT time_key, n FROM dt LEFT JOIN (SELECT hour(ts) * 2 + minute(ts) // 30 AS time_key, count(*) AS n FROM nat GROUP BY 1) USING (time_key))")
add("src14_bounds", "region_id:i lo hi", lambda w: readers.bounds(w.raw.regional, "ts", ["region_id"]), "(SELECT region_id, min(ts) AS lo, max(ts) AS hi FROM rawreg GROUP BY 1)")
add("src15_distinct_times", "ts", lambda w: readers.distinct_times(w.raw.mix, "ts"), "(SELECT DISTINCT ts FROM rawmix)")
add("src16_before", "ts actual:i", lambda w: forecasting.before(w.raw.national, "2024-03-25 00:00:00"), "nat WHERE ts < TIMESTAMP '2024-03-25'")
add("src17_irregular", "ts next_ts", lambda w: ops.regular(w.raw.national.select("ts"), [], "ts"), "(SELECT * FROM (SELECT ts, lead(ts) OVER (ORDER BY ts) AS next_ts FROM nat) WHERE next_ts <> ts + INTERVAL 30 MINUTE)")

_CUT = "2024-04-08 00:00:00"


def _batch(w):
    """The last days again: a third of the values corrected, each row twice with the later one counting."""
    late = w.raw.national.filter(F.col("ts") >= F.lit("2024-04-06").cast("timestamp_ntz")).select("ts", "actual")
    changed = late.withColumn("actual", F.when(fn.slot("ts") % 3 == 0, F.col("actual") + 1).otherwise(F.col("actual")))
    return late.withColumns({"actual": F.lit(-1), "arrival": F.lit(1)}).unionByName(changed.withColumn("arrival", F.lit(2)))


def _classified(w):
    old = w.raw.national.filter(F.col("ts") < F.lit(_CUT).cast("timestamp_ntz")).select("ts", "actual")
    return up.classify(old, _batch(w), ["ts"], (), "arrival")


_CLASS = f"""(SELECT ts, CASE WHEN k % 3 = 0 THEN actual + 1 ELSE actual END AS actual, CASE WHEN ts >= TIMESTAMP '{_CUT}' THEN 'insert' WHEN k % 3 = 0 AND actual IS NOT NULL THEN 'update' ELSE 'same' END AS change
  FROM (SELECT *, hour(ts) * 2 + minute(ts) // 30 AS k FROM nat WHERE ts >= TIMESTAMP '2024-04-06'))"""
add("snk1_classify", "ts actual:i change", _classified, _CLASS)
add("snk2_stats", "inserted:i updated:i unchanged:i", lambda w: up.upsert_stats(_classified(w)), f"(SELECT count(*) FILTER (change = 'insert') AS inserted, count(*) FILTER (change = 'update') AS updated, count(*) FILTER (change = 'same') AS unchanged FROM {_CLASS})")
add("set07_keep_last", "ts actual:i", lambda w: ops.keep_last(_batch(w), ["ts"], "arrival"), f"(SELECT ts, actual FROM {_CLASS})")


def _upserted(w):
    """The series written month by month, then the corrected batch merged twice: the second time nothing changes."""
    path = feeds.shared(w.raw.spark)
    first = w.raw.national.filter(F.col("ts") < F.lit(_CUT).cast("timestamp_ntz")).select("ts", "actual").withColumn("arrival", F.lit(0))
    for batch in (first, _batch(w), _batch(w)):
        up.upsert(w.raw.spark, path, batch, ["ts"], "ts", (), "arrival")
    return up.rows_of(w.raw.spark, path).select("ts", "actual")


add("snk1_upsert", "ts actual:i", _upserted, f"(SELECT ts, actual FROM nat WHERE ts < TIMESTAMP '2024-04-06' UNION ALL SELECT ts, actual FROM {_CLASS})")


def _snapshots(w):
    """Both versions that the two merges made, each as its readers see it; the third merge changes nothing and makes none."""
    spark, path = w.raw.spark, feeds.shared(w.raw.spark)
    first = w.raw.national.filter(F.col("ts") < F.lit(_CUT).cast("timestamp_ntz")).select("ts", "actual").withColumn("arrival", F.lit(0))
    for batch in (first, _batch(w), _batch(w)):
        up.upsert(spark, path, batch, ["ts"], "ts", (), "arrival")
    return readers.merge_all([versions.read(spark, path, version=v).select(F.lit(v).alias("version"), "ts", "actual") for v in versions.versions(spark, path)])


add("snk1_snapshots", "version:i ts actual:i", _snapshots,
    f"(SELECT 1 AS version, ts, actual FROM nat WHERE ts < TIMESTAMP '{_CUT}' UNION ALL SELECT 2, ts, actual FROM nat WHERE ts < TIMESTAMP '2024-04-06' UNION ALL SELECT 2, ts, actual FROM {_CLASS})")


# ---- tables on disk: scans, conforming, published files, refreshes ----

_TEXTS = ("forecast", "actual", "ts", "end_ts")  # columns that land as text


def _landed(w):
    """The national rows as they land: every number and time as text, in another order of columns."""
    full = w.raw.national.select("band", "actual", "forecast", (F.col("ts") + F.expr("INTERVAL 30 MINUTES")).alias("end_ts"), F.lit("2024-05-01 00:00:00").alias("fetched_at"), "ts")
    return full.withColumns({c: F.col(c).cast("string") for c in _TEXTS})


def _stored(w):
    path = feeds.shared(w.raw.spark)
    rows = up.conform(_landed(w), readers.NATIONAL.struct())
    up.upsert(w.raw.spark, path, rows, readers.NATIONAL.keys, "ts", readers.NATIONAL.metadata)
    return path


add("src01_scan", "ts end_ts forecast:i actual:i band", lambda w: readers.NATIONAL.scan(w.raw.spark, _stored(w)), "(SELECT *, ts + INTERVAL 30 MINUTE AS end_ts FROM nat)")
add("src11_conform", "ts forecast:i actual:i band", lambda w: up.conform(_landed(w), readers.NATIONAL.struct()), "nat")
add("src12_first_run", "day change n:i", lambda w: up.classify(readers.NATIONAL.scan(w.raw.spark, feeds.shared(w.raw.spark)), up.conform(_landed(w), readers.NATIONAL.struct()), ["ts"], readers.NATIONAL.metadata).groupBy(F.to_date("ts").alias("day"), "change").agg(F.count(F.lit(1)).alias("n")),
    "(SELECT CAST(ts AS DATE) AS day, 'insert' AS change, count(*) AS n FROM nat GROUP BY 1)")


def _seeded(w):
    """A seed kept as CSV with declared types, joined to the mix."""
    path = feeds.shared(w.raw.spark)
    w.raw.fuels.coalesce(1).write.option("header", True).csv(path)
    seed = readers.seed_csv(w.raw.spark, path, "fuel string, label string, category string, is_fossil boolean, is_renewable boolean, is_low_carbon boolean, sort_order int")
    return w.raw.mix.join(F.broadcast(seed), "fuel").groupBy("category", "is_low_carbon").agg(F.count(F.lit(1)).alias("n"), F.max("sort_order").alias("last_place"))


add("src10_seed_csv", "category is_low_carbon n:i last_place:i", _seeded, "(SELECT category, is_low_carbon, count(*) AS n, max(sort_order) AS last_place FROM rawmix JOIN fuels USING (fuel) GROUP BY ALL)")


def _layers(w):
    """The fact as a shared table, the model over it as a view. The table is the application's own: a warehouse may outlive it."""
    own = re.sub(r"\W", "_", w.raw.spark.sparkContext.applicationId).lower()
    fact = sinks.materialise(w.raw.national, f"tideline_national_{own}", True)
    daily = fact.groupBy(F.to_date("ts").alias("day")).agg(F.avg("actual").alias("mean_actual"), F.count("actual").alias("n"))
    return sinks.materialise(daily, "tideline_daily", False)


add("snk3_layers", "day mean_actual:f n:i", lambda w: (_layers(w), w.raw.spark.table("tideline_daily"))[1], "(SELECT CAST(ts AS DATE) AS day, avg(actual) AS mean_actual, count(actual) AS n FROM nat GROUP BY 1)")


EXPORT_DAYS = 90  # of half-hours; everything else is exported whole


def _star(w):
    """Five dimensions and five facts as ordered CSV with a manifest; the counts in it are those of the files."""
    path, n = feeds.shared(w.raw.spark), w.national
    last = n.agg((F.max("ts") - F.expr(f"INTERVAL {EXPORT_DAYS} DAYS")).alias("since"))
    recent = n.crossJoin(F.broadcast(last)).filter("ts >= since").select("ts", "date_key", "time_key", "forecast", "actual", "error")
    tables = {
        "dim_date": (w.dim_date, ["date_key"]), "dim_time": (w.dim_time, ["time_key"]), "dim_region": (w.dim_region, ["region_id"]), "dim_fuel": (w.dim_fuel, ["fuel"]), "dim_country": (w.dim_country, ["country"]),
        "national_half_hourly": (recent, ["ts"]), "national_daily": (adhoc.daily_rollup(w), ["day"]), "mix_daily": (adhoc.daily_mix(w), ["day", "fuel"]), "regional_daily": (adhoc.daily_regional(w), ["day", "region_id"]), "country_year": (w.country_intensity, ["country", "year"]),
    }
    manifest = sinks.export_star(w.raw.spark, tables, path)
    files = readers.merge_all([w.raw.spark.read.option("header", True).csv(f"{path}/{name}").agg(F.count(F.lit(1)).alias("read_back")).withColumn("table", F.lit(name)) for name in tables])
    return manifest.join(files, "table").withColumnRenamed("table", "dataset")


_EXPORTED = {
    "dim_date": "dd", "dim_time": "dt", "dim_region": "regions", "dim_fuel": "fuels", "dim_country": "dc", "national_half_hourly": f"fn WHERE ts >= (SELECT max(ts) FROM fn) - INTERVAL {EXPORT_DAYS} DAY", "national_daily": "(SELECT DISTINCT day FROM fd)",
    "mix_daily": "(SELECT DISTINCT day, fuel FROM fm JOIN dd USING (date_key))", "regional_daily": "(SELECT DISTINCT day, region_id FROM freg JOIN dd USING (date_key))", "country_year": "ci",
}
add("snk5_star_export", "dataset rows:i read_back:i", _star, "(SELECT *, rows AS read_back FROM (" + " UNION ALL ".join(f"SELECT '{name}' AS dataset, count(*) AS rows FROM {source}" for name, source in _EXPORTED.items()) + "))")


def _restored(w):
    """Months published as files with a manifest; a changed file stops the restore, the whole ones give the table back."""
    spark, published, table = w.raw.spark, feeds.shared(w.raw.spark), feeds.shared(w.raw.spark)
    rows = up.conform(_landed(w), readers.NATIONAL.struct())
    rows.write.parquet(published)
    manifest = up.file_manifest(spark, published, rows=True).persist()
    try:
        up.restore(spark, manifest.withColumn("sha256", F.reverse("sha256")), published, table, readers.NATIONAL.keys, "ts", readers.NATIONAL.metadata)
        refused = False
    except ValueError:
        refused = not up.exists(spark, table)
    done = up.restore(spark, manifest, published, table, readers.NATIONAL.keys, "ts", readers.NATIONAL.metadata)
    manifest.unpersist()
    return readers.NATIONAL.scan(spark, table).select("ts", "actual", F.lit(refused).alias("refused"), F.lit(done["inserted"]).alias("inserted"))


add("snk7_restore", "ts actual:i refused inserted:i", _restored, "(SELECT ts, actual, true AS refused, count(*) OVER () AS inserted FROM nat)")


def _refreshed(w):
    """A yearly file landed, landed again as it was, then with a column missing: the good rows stay."""
    spark, table = w.raw.spark, feeds.shared(w.raw.spark)
    good, bad = feeds.shared(spark), feeds.shared(spark)
    rows = w.raw.yearly.select("area", "year", "source", "generation")
    rows.coalesce(1).write.option("header", True).csv(good)
    rows.drop("generation").coalesce(1).write.option("header", True).csv(bad)
    columns = {"area": ("area", "string"), "year": ("year", "int"), "source": ("source", "string"), "generation": ("generation", "double")}
    said = [up.refresh(spark, landed, table, lambda path: readers.strict_csv(spark, path, columns, ["area", "year"])) for landed in (good, good, bad)]
    return up.current(spark, table).withColumn("said", F.lit(",".join(said)))


add("snk8_refresh", "area year:i source generation:f said", _refreshed, "(SELECT area, year, source, generation, 'replaced,unchanged,kept' AS said FROM yearly)")
add("inc8_issued", "issued ts forecast:i", lambda w: readers.issued_now(w.raw.national.select("ts", "forecast"), "2024-04-10 09:47:00", fn.as_of("2024-04-10 10:05:00")), "(SELECT TIMESTAMP '2024-04-10 09:30:00' AS issued, ts, forecast FROM nat)")


def _events(w):
    schema = w.raw.table("events").schema
    return feeds.file_stream(w.raw.spark, w.raw.dir, "events.parquet", schema)


def _streamed_upsert(w):
    path = feeds.shared(w.raw.spark)
    rows = _events(w).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", F.col("event_id").alias("arrival"))
    feeds.upsert_stream(rows, f"{path}/table", path, ["event_id"], "ts", (), "arrival")
    return up.rows_of(w.raw.spark, f"{path}/table").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"))


add("str1_upsert_stream", "day n:i users:i", _streamed_upsert, "(SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1)")


def _incremental(w):
    """Two sources read to their ends, once more without anything new, and one that fails: a report row for each run and source."""
    spark, path = w.raw.spark, feeds.shared(w.raw.spark)

    def sources():
        orders = feeds.file_stream(spark, w.raw.dir, "orders.parquet", w.raw.table("orders").schema)
        events = _events(w).select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id", F.col("event_id").alias("arrival"))
        orders = orders.select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("ts"), F.col("o_orderkey").alias("arrival"))
        broken = orders.withColumn("o_orderkey", F.lit(None).cast("long"))  # null keys are refused
        return {"events": (events, ["event_id"], "ts", "arrival"), "orders": (orders, ["o_orderkey"], "ts", "arrival"), "broken": (broken, ["o_orderkey"], "ts", "arrival")}

    runs = [feeds.incremental_run(spark, sources(), path).withColumn("run", F.lit(k)) for k in (1, 2)]
    return readers.merge_all(runs).withColumn("failed", F.col("problem").isNotNull())


add("inc7_report", "run:i dataset inserted:i updated:i unchanged:i failed", _incremental,
    """(SELECT run, dataset, CASE WHEN run = 1 THEN n ELSE 0 END AS inserted, 0 AS updated, 0 AS unchanged, dataset = 'broken' AS failed FROM range(1, 3) r(run),
    (SELECT 'events' AS dataset, count(DISTINCT event_id) AS n FROM events UNION ALL SELECT 'orders', count(DISTINCT o_orderkey) FROM orders UNION ALL SELECT 'broken', 0))""")  # fmt: skip
add("str2_half_hourly", "ts n:i cents:i", lambda w: feeds.collect_append(feeds.half_hourly(_events(w).withColumn("cents", F.round(F.col("value") * 100).cast("long")), "ts"), "ts timestamp_ntz, n long, cents long"),
    "(SELECT * FROM (SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS ts, count(*) AS n, sum(CAST(round(value * 100) AS BIGINT)) AS cents FROM events GROUP BY 1) WHERE ts + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 2 DAY)")
add("str3_outages", "key:i start_ts end_ts", lambda w: feeds.collect_append(feeds.outages(_events(w), "user_id", "ts"), "key long, start_ts timestamp_ntz, end_ts timestamp_ntz"),
    "(SELECT * FROM (SELECT user_id AS key, t + INTERVAL 30 MINUTE AS start_ts, lead(t) OVER (PARTITION BY user_id ORDER BY t) AS end_ts FROM (SELECT DISTINCT user_id, time_bucket(INTERVAL 30 MINUTE, ts) AS t FROM events)) WHERE end_ts > start_ts)")


def _final_outages(w):
    own = feeds.state_session(w.raw.spark)
    stream = feeds.file_stream(own, w.raw.dir, "events.parquet", w.raw.table("events").schema)
    return feeds.collect_append(feeds.final_outages(stream, "user_id", "ts"), "key long, kind string, start_ts timestamp_ntz, end_ts timestamp_ntz")


add("str3_final_outages", "key:i kind start_ts end_ts", _final_outages,
    """(WITH seen AS (SELECT DISTINCT user_id AS key, time_bucket(INTERVAL 30 MINUTE, ts) AS t FROM events), bound AS (SELECT max(ts) - INTERVAL 2 DAY AS b FROM events),
    held AS (SELECT key, t + INTERVAL 30 MINUTE AS start_ts, lead(t) OVER (PARTITION BY key ORDER BY t) AS end_ts FROM seen)
    SELECT key, 'hole' AS kind, start_ts, end_ts FROM held, bound WHERE end_ts > start_ts AND end_ts <= date_trunc('second', b)
    UNION ALL SELECT key, 'silent', start_ts, NULL FROM held, bound WHERE end_ts IS NULL AND start_ts + INTERVAL 24 HOUR <= date_trunc('second', b))""")  # fmt: skip

_REFETCH = 7


def _bounded(w):
    """Events landed in three files: most of them; a part that comes late; that part again with corrections of the last days. What the table and the late rows hold."""
    spark, landed, path = w.raw.spark, feeds.shared(w.raw.spark), feeds.shared(w.raw.spark)
    rows = w.raw.table("events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    slow = F.col("event_id") % 97 == 0
    recent = rows.crossJoin(F.broadcast(rows.agg(F.max("ts").alias("end")))).filter((F.col("event_id") % 5 == 0) & (F.col("ts") >= F.col("end") - F.expr("INTERVAL 2 DAYS"))).select("event_id", "ts", (F.col("cents") + 1).alias("cents"))
    for k, part in enumerate((rows.filter(~slow), rows.filter(slow), rows.filter(slow).unionByName(recent.filter(~slow)))):
        part.withColumn("arrival", F.lit(k)).coalesce(1).write.mode("append").parquet(landed)
    schema = spark.read.parquet(landed).schema
    feeds.bounded_upsert_stream(feeds.file_stream(spark, landed, "part", schema, 1), path, ["event_id"], "ts", _REFETCH, (), "arrival")
    return readers.merge_all([up.rows_of(spark, f"{path}/{name}", schema).groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents")).withColumn("place", F.lit(name)) for name in ("table", "late")])


add("str1_bounded_upsert", "place day n:i cents:i", _bounded,
    f"""(WITH e AS (SELECT event_id, ts, CAST(round(value * 100) AS BIGINT) AS cents, event_id % 97 = 0 AS slow FROM events), b AS (SELECT max(ts) FILTER (NOT slow) - INTERVAL {_REFETCH} DAY AS bound, max(ts) AS newest FROM e)
    SELECT CASE WHEN slow AND ts < bound THEN 'late' ELSE 'table' END AS place, CAST(ts AS DATE) AS day, count(*) AS n, sum(cents + CASE WHEN NOT slow AND event_id % 5 = 0 AND ts >= newest - INTERVAL 2 DAY THEN 1 ELSE 0 END) AS cents FROM e, b GROUP BY 1, 2)""")  # fmt: skip


def _functions(w):
    """Every time function once, over the national series' times."""
    k, at = fn.slot("ts"), lambda minutes: F.timestamp_add("MINUTE", minutes, F.col("ts"))
    t = w.raw.national.select("ts", at(k % 3 * 17).alias("odd"), at((k % 7 - 2) * 15).alias("end"), F.timestamp_add("MONTH", k % 12, F.col("ts")).alias("later"))
    start = F.lit("2024-03-11 00:00:00").cast("timestamp_ntz")
    return t.select(
        "ts", fn.to_local("ts").alias("local_ts"), fn.slot("ts").alias("slot"), fn.season(F.month("later")).alias("season"), fn.date_key("ts").alias("date_key"), fn.iso_weekday("ts").alias("weekday"), fn.minutes_between("ts", "odd").alias("minutes"),
        fn.floor_half_hour("odd").alias("floor_ts"), fn.ceil_half_hour("odd").alias("ceil_ts"), fn.year_split("later").alias("split_ts"), fn.slot_label(fn.slot("ts")).alias("label"), fn.grid_index("ts", start).alias("idx"),
        fn.grid_time(fn.grid_index("ts", start), start).alias("back_ts"), fn.is_interval("ts", "end").alias("valid"), fn.lead_band(fn.slot("ts") + 1).alias("band"), fn.last_known_offset(2 * fn.slot("ts") + 1).alias("back_offset"),
        fn.erfc(F.lit(1.0) * fn.slot("ts") / 24).alias("tail"), fn.shown_p(F.lit(1.0) * fn.slot("ts") / 40000).alias("shown"),
    )


add("fn_time_functions", "ts local_ts slot:i season date_key:i weekday:i minutes:i floor_ts ceil_ts split_ts label idx:i back_ts valid band:i back_offset:i tail:f shown", _functions,
    """(SELECT ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London' AS local_ts, k AS slot, CASE WHEN month(later) IN (12, 1, 2) THEN 'Winter' WHEN month(later) <= 5 THEN 'Spring' WHEN month(later) <= 8 THEN 'Summer' ELSE 'Autumn' END AS season, CAST(strftime(ts, '%Y%m%d') AS INT) AS date_key, isodow(ts) AS weekday, k % 3 * 17 AS minutes, time_bucket(INTERVAL 30 MINUTE, odd) AS floor_ts, CASE WHEN odd = time_bucket(INTERVAL 30 MINUTE, odd) THEN odd ELSE time_bucket(INTERVAL 30 MINUTE, odd) + INTERVAL 30 MINUTE END AS ceil_ts,
    make_timestamp(CAST(year(later + INTERVAL 30 MINUTE) AS BIGINT), 12, 31, 23, 30, 0) AS split_ts, printf('%02d:%02d', CAST(k // 2 AS INT), CAST(k % 2 * 30 AS INT)) AS label, CAST((epoch(ts) - epoch(TIMESTAMP '2024-03-11')) / 1800 AS BIGINT) AS idx, ts AS back_ts, (k % 7 - 2) * 15 % 30 = 0 AND k % 7 > 2 AS valid, k // 12 AS band, CASE WHEN 2 * k + 1 <= 48 THEN 48 ELSE 96 END AS back_offset,
    ((((1.061405429 * t - 1.453152027) * t + 1.421413741) * t - 0.284496736) * t + 0.254829592) * t * exp(-k * k / 576.0) AS tail, CASE WHEN k / 40000.0 < 0.001 THEN '<0.001' ELSE printf('%.3f', k / 40000.0) END AS shown
    FROM (SELECT ts, k, 1 / (1 + 0.3275911 * k / 24.0) AS t, ts + (k % 3 * 17) * INTERVAL 1 MINUTE AS odd, ts + (k % 12) * INTERVAL 1 MONTH AS later FROM (SELECT ts, hour(ts) * 2 + minute(ts) // 30 AS k FROM nat)))""")  # fmt: skip
