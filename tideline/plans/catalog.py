"""Every query by name: its columns, its Spark plan, and the SQL that another engine checks it with."""

from __future__ import annotations

import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import staging
from ..sources.bound import Bound
from .oracle import prelude, typed
from .warehouse import Params, Warehouse

#: Settings under which the tables at hand show every branch.
SETTINGS = Params(job_hours=2, lookback_days=14, complete_starts=30, window=("2024-03-11", "2024-04-09"), group_members=5, first_year=1990, base_year=1996, home="C01", union="C02", world="C03")

_entries: dict[str, tuple[str, Callable[[Warehouse], DataFrame], str | None]] = {}


def add(name: str, spec: str, plan: Callable[[Warehouse], DataFrame], source: str | None) -> None:
    """A query with its columns ("a:i b:f c": whole number, rounded, as it is), plan, and FROM clause over the prelude."""
    _entries[name] = (spec, plan, source)


def shaped(df: DataFrame, spec: str) -> DataFrame:
    out = []
    for item in spec.split():
        name, _, kind = item.partition(":")
        c = F.col(name)
        out.append({"i": c.cast("long"), "f": F.round(c.cast("double"), 6)}.get(kind, c).alias(name))
    return df.select(*out)


MODELS = {
    # name: (columns, attribute of Warehouse, CTE)
    "m07_half_hours": ("ts end_ts local_ts local_date date_key:i time_key:i forecast:i actual:i band is_missing is_forecast_implausible is_actual_implausible is_actual_missing", "half_hours", "hh"),
    "m08_mix_wide": ("ts gas_pct:f coal_pct:f nuclear_pct:f wind_pct:f solar_pct:f imports_pct:f fossil_pct:f renewable_pct:f low_carbon_pct:f total_pct:f", "mix_wide", "wide"),
    "m10_country_year": ("country year:i generation:f emissions:f intensity:f gas_share:f coal_share:f nuclear_share:f solar_share:f wind_share:f fossil_share:f clean_share:f", "country_year", "cy"),
    "m11_job_windows": ("ts local_ts day date_key:i time_key:i job_actual:f job_forecast:f", "job_windows", "jobs"),
    "m12_dim_date": ("date_key:i day year:i quarter:i month:i month_name year_month day_of_month:i weekday:i day_name is_weekend is_holiday holiday is_working_day season", "dim_date", "dd"),
    "m16_dim_country": ("area country peer_group sort_order:i first_year:i latest_year:i", "dim_country", "dc"),
    "m17_national": ("ts date_key:i time_key:i forecast:i actual:i error:i band is_missing is_mix_missing gas_pct:f wind_pct:f fossil_pct:f low_carbon_pct:f", "national", "fn"),
    "m18_mix": ("ts fuel date_key:i time_key:i share:f", "mix", "fm"),
    "m19_regional": ("ts region_id:i date_key:i time_key:i local_ts forecast:i band", "regional", "freg"),
    "m20_regional_mix_daily": ("date_key:i region_id:i fuel mean_share:f periods:i", "regional_mix_daily", "fregmix"),
    "m21_snapshots": ("issued ts lead_minutes:i date_key:i forecast:i is_forecast_implausible actual:i error:i", "snapshots", "snap"),
    "m22_country_electricity": ("country year:i source is_total generation:f share:f emissions:f intensity:f", "country_electricity", "elec"),
    "m23_country_intensity": ("country year:i generation:f emissions:f intensity:f change:f gas_share:f clean_share:f", "country_intensity", "ci"),
    "m25_start_slots": ("time_key:i label mean_job:f working_mean:f non_working_mean:f jobs:i rank_lowest:i", "start_slots", "slots"),
    "m26_week_slots": ("weekday:i day_name time_key:i label mean_job:f jobs:i rank_lowest:i", "week_slots", "wslots"),
    "m27_daily_strategies": ("day date_key:i start_options:i fixed_0000:f fixed_0900:f fixed_1700:f any_start:f profile_guided:f profile_time_key:i forecast_guided:f forecast_time_key:i oracle:f oracle_time_key:i", "daily_strategies", "daily"),
    "m28_savings": ("strategy label sort_order:i days:i mean_job:f saving_0000:f saving_0000_pct:f saving_0900:f saving_0900_pct:f saving_1700:f saving_1700_pct:f job_kw:f job_hours:f kg_per_run:f", "savings", "sav"),
    "m29_weekly_profile": ("weekday:i day_name time_key:i label mean_actual:f median_actual:f periods:i", "weekly_profile", "weekly"),
    "m30_monthly": ("year_month year:i month:i season month_start mean_actual:f p10_actual:f p90_actual:f min_actual:i max_actual:i mean_wind_pct:f mean_solar_pct:f mean_gas_pct:f mean_low_carbon_pct:f with_actual:i periods:i coverage_pct:f", "monthly", "monthly"),
    "m31_annual": ("year:i mean_actual:f mean_low_carbon_pct:f mean_wind_pct:f mean_gas_pct:f mean_coal_pct:f with_actual:i first_date last_date is_complete", "annual", "annual"),
    "m32_seasonal_profile": ("season time_key:i label mean_actual:f mean_solar_pct:f mean_wind_pct:f periods:i", "seasonal_profile", "sprof"),
    "m33_seasonal_summary": ("season season_order:i mean_actual:f p10_actual:f p90_actual:f mean_daily_range:f mean_wind_pct:f mean_solar_pct:f mean_gas_pct:f periods:i days:i", "seasonal_summary", "ssum"),
    "m34_regional_report": ("region_id:i region nation is_aggregate mean_forecast:f winter_mean:f spring_mean:f summer_mean:f autumn_mean:f p10_forecast:f p90_forecast:f mean_wind_pct:f mean_low_carbon_pct:f mean_fossil_pct:f periods:i rank_lowest:i", "regional_report", "rrep"),
    "m35_forecast_accuracy": ("scope scope_value periods:i mae:f rmse:f mape_pct:f bias:f within_10_pct:f within_25_pct:f mean_actual:f", "forecast_accuracy", "acc"),
    "m36_snapshot_accuracy": ("lead_band min_lead:i snapshots:i periods:i mae:f rmse:f mape_pct:f bias:f", "snapshot_accuracy", "sacc"),
    "m37_country_trend": ("country name peer_group year:i generation:f emissions:f intensity:f is_aggregate", "country_trend", "ct"),
    "m38_country_comparison": ("country name peer_group is_aggregate year:i intensity:f ratio_to_home:f ratio_to_union:f base_intensity:f change_pct:f generation:f fossil_share:f gas_share:f coal_share:f nuclear_share:f solar_share:f wind_share:f clean_share:f", "country_comparison", "cc"),
    "m39_annual_export": ("country name peer_group year:i intensity:f generation:f emissions:f basis licence is_latest", "annual_export", "(SELECT country, area AS name, peer_group, year, round(intensity, 1) AS intensity, round(generation, 2) AS generation, round(emissions, 3) AS emissions, 'CO2-equivalent' AS basis, 'CC BY 4.0' AS licence, year = latest_year AS is_latest FROM ci JOIN dc USING (country) WHERE peer_group IN ('GCC', 'UK', 'EU') AND year >= 1990)"),
}
for _name, (_spec, _attr, _cte) in MODELS.items():
    add(_name, _spec, lambda w, a=_attr: getattr(w, a), _cte)

STAGING = {
    # name: (columns, what stages it, raw table, CTE)
    "m01_staged_national": ("ts forecast:i actual:i band", staging.national, "national", "nat"),
    "m02_staged_mix": ("ts fuel share:f", staging.mix, "mix", "rawmix"),
    "m03_staged_regional": ("ts region_id:i forecast:i band", staging.regional, "regional", "rawreg"),
    "m04_staged_regional_mix": ("ts region_id:i fuel share:f", staging.regional_mix, "regional_mix", "rawregmix"),
}


def as_landed(df: DataFrame) -> DataFrame:
    """A raw table as the feed would write it: text throughout, padded numbers, names with capitals, blanks for nulls."""
    shown = {"timestamp_ntz": lambda c: F.date_format(c, staging.MOMENT), "string": F.initcap}
    plain = lambda c: F.concat(F.lit(" "), F.col(c).cast("string"))
    return df.select(*(F.coalesce(shown.get(kind, plain)(c), F.lit("")).alias(c) for c, kind in df.dtypes))


for _name, (_spec, _stage, _attr, _cte) in STAGING.items():
    add(_name, _spec, lambda w, f=_stage, a=_attr: f(as_landed(getattr(w.raw, a))), _cte)
add("m06_staged_yearly", "area code year:i source is_total generation:f share:f emissions:f intensity:f", lambda w: w.raw.yearly, "yearly")


def _used(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """A dimension with the number of the fact's rows that refer to each member."""
    return dim.join(fact.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "left").withColumn("n", F.coalesce("n", F.lit(0)))


add("m13_dim_time", "time_key:i label hour:i minute:i day_part is_evening_peak n:i", lambda w: _used(w.dim_time, w.half_hours, "time_key"), "(SELECT dt.*, coalesce(n, 0) AS n FROM dt LEFT JOIN (SELECT time_key, count(*) AS n FROM hh GROUP BY 1) USING (time_key))")
add("m14_dim_region", "region_id:i region nation is_aggregate n:i", lambda w: _used(w.dim_region, w.raw.regional, "region_id"), "(SELECT regions.*, coalesce(n, 0) AS n FROM regions LEFT JOIN (SELECT region_id, count(*) AS n FROM rawreg GROUP BY 1) USING (region_id))")
add("m15_dim_fuel", "fuel label category is_fossil is_renewable is_low_carbon sort_order:i n:i", lambda w: _used(w.dim_fuel, w.raw.mix, "fuel"), "(SELECT fuels.*, coalesce(n, 0) AS n FROM fuels LEFT JOIN (SELECT fuel, count(*) AS n FROM rawmix GROUP BY 1) USING (fuel))")
add("m05_staged_snapshots", "issued ts forecast:i lead_minutes:i", lambda w: w.staged_snapshots, "(SELECT *, date_diff('minute', issued, ts) AS lead_minutes FROM rawsnap)")
add("m09_regional_half_hours", "ts local_ts region_id:i forecast:i band", lambda w: w.regional_half_hours, "freg")
add("m24_report_window", "start_date end_date days:i", lambda w: Warehouse(w.raw, Params()).report_window, "(SELECT *, end_date - start_date + 1 AS days FROM autowin)")
add("m24_report_window_set", "start_date end_date days:i job_hours:f", lambda w: w.report_window, "(SELECT *, end_date - start_date + 1 AS days, 2.0 AS job_hours FROM win)")


def _run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    spec, plan, _ = _entries[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        w = Warehouse(Bound(spark, sf_dir), SETTINGS)
        out = shaped(plan(w), spec)
        weakref.finalize(out, w.release).atexit = False  # what is kept goes with the result; a later use computes it again
        return out

    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _run(name) for name in _entries}


def oracle_sql() -> dict[str, str]:
    start = prelude()
    return {name: f"{start}\n{typed(spec, source)}" for name, (spec, _, source) in _entries.items() if source}
