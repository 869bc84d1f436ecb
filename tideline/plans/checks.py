"""The catalogue of checks on every table, and the SQL that counts the same failures."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions import timefn as fn
from ..operators import quality
from ..operators.quality import Table
from .catalog import add
from .warehouse import Warehouse

NOW = "2024-04-20 00:00:00"
BANDS = "'very low', 'low', 'moderate', 'high', 'very high'"


def null(column: str) -> tuple:
    return (f"{column} present", f"{column} is null", None, 1, 1)


def within(column: str, low, high, where: str | None = None, err: int = 1) -> tuple:
    """Values in a range, nulls pass; warns from the first, errs from `err` on."""
    return (f"{column} in [{low}, {high}]" + (f" where {where}" if where else ""), f"{column} < {low} or {column} > {high}", where, 1, err)


def one_of(column: str, values: str) -> tuple:
    return (f"{column} of the known values", f"{column} not in ({values})", None, 1, 1)


def aligned(column: str) -> tuple:
    return (f"{column} on a half-hour", f"extract(minute from {column}) not in (0, 30) or extract(second from {column}) <> 0", None, 1, 1)


NEVER = 1_000_000_000  # failures that only warn
CATALOGUE = (
    # staging
    Table("national", (null("ts"), aligned("ts"), within("forecast", 10, 700, err=101), within("actual", 10, 700, err=101), one_of("band", BANDS)), (("ts",),), gaps=(((), "ts", "national"),), recent=(("ts", 36),)),
    Table("mix", (null("ts"), null("fuel"), within("share", 0, 100)), (("ts", "fuel"),), (("fuel", ("fuels", "fuel")),), (("share", ("ts",), 1.5),), (((), "ts", None),)),
    Table("regional", (null("ts"), within("forecast", 0, 1000), one_of("band", BANDS)), (("ts", "region_id"),), (("region_id", ("regions", "region_id")),), gaps=((("region_id",), "ts", "regional"),)),
    Table("regional_mix", (within("share", 0, 100),), (("ts", "region_id", "fuel"),), (("fuel", ("fuels", "fuel")), ("region_id", ("regions", "region_id")))),
    Table("snapshots", (null("issued"), aligned("ts"), within("lead_minutes", -30, 2880)), (("issued", "ts"),)),
    Table("yearly", (null("area"), within("year", 1980, 2100), within("share", 0, 100, "not is_total"), within("intensity", 0, 1500, err=NEVER)), (("area", "year", "source"),), (("area", ("countries", "area")),)),
    # intermediates
    Table("half_hours", (within("time_key", 0, 47), null("local_date")), (("ts",),), gaps=(((), "ts", None),)),
    Table("mix_wide", (within("low_carbon_pct", 0, 101.5),), (("ts",),)),
    Table("job_windows", (within("job_actual", 10, 700, err=NEVER), within("job_forecast", 10, 700, err=NEVER)), (("ts",),)),
    # dimensions and facts
    Table("dim_date", (null("day"), within("month", 1, 12), within("weekday", 1, 7)), (("date_key",), ("day",))),
    Table("dim_time", (within("hour", 0, 23),), (("time_key",), ("label",))),
    Table("fact_national", (within("error", -400, 400),), (("ts",),), (("date_key", ("dim_date", "date_key")), ("time_key", ("dim_time", "time_key")))),
    Table("fact_mix", (within("share", 0, 100),), (("ts", "fuel"),), (("date_key", ("dim_date", "date_key")), ("fuel", ("fuels", "fuel")))),
    Table("fact_regional", (within("forecast", 0, 1000),), (("ts", "region_id"),), (("date_key", ("dim_date", "date_key")), ("region_id", ("regions", "region_id")))),
    Table("country_intensity", (within("intensity", 0, 1500), within("gas_share", 0, 100.5)), (("country", "year"),), (("country", ("countries", "country")),)),
    # reports
    Table("savings", (within("days", 1, 400), one_of("strategy", "'fixed_0000', 'fixed_0900', 'fixed_1700', 'any_start', 'profile_guided', 'forecast_guided', 'oracle'")), (("strategy",),)),
    Table("monthly", (within("coverage_pct", 0, 100),), (("year_month",),)),
    Table("forecast_accuracy", (within("mae", 0, 200), within("within_10_pct", 0, 100)), (("scope", "scope_value"),)),
    Table("regional_report", (within("p10_forecast", 0, 1000),), (("region_id",),), (("region_id", ("regions", "region_id")),)),
    # seeds
    Table("fuels", (null("fuel"),), (("fuel",),)),
    Table("regions", (null("region_id"),), (("region_id",), ("region",))),
    Table("countries", (null("country"),), (("country",), ("area",))),
)


def tables(w: Warehouse) -> dict[str, DataFrame]:
    """Every table by its name in the catalogue; those read several times are kept."""
    raw = {n: w._keep(getattr(w.raw, n)) for n in ("national", "mix", "regional", "regional_mix", "yearly")}
    seeds = {n: getattr(w.raw, n) for n in ("fuels", "regions", "countries")}
    models = {n: getattr(w, n) for n in ("half_hours", "mix_wide", "job_windows", "dim_date", "dim_time", "country_intensity", "savings", "monthly", "forecast_accuracy", "regional_report")}
    return {**raw, **seeds, **models, "snapshots": w.staged_snapshots, "fact_national": w.national, "fact_mix": w.mix, "fact_regional": w.regional}


#: What each table is called in the SQL.
CTES = {
    "national": "nat", "mix": "rawmix", "regional": "rawreg", "regional_mix": "rawregmix", "snapshots": "(SELECT *, date_diff('minute', issued, ts) AS lead_minutes FROM rawsnap)", "yearly": "yearly", "half_hours": "hh", "mix_wide": "wide", "job_windows": "jobs", "dim_date": "dd", "dim_time": "dt",
    "fact_national": "fn", "fact_mix": "fm", "fact_regional": "freg", "country_intensity": "ci", "savings": "sav", "monthly": "monthly", "forecast_accuracy": "acc", "regional_report": "rrep", "fuels": "fuels", "regions": "regions", "countries": "countries",
}


def oracle() -> str:
    """Every line of the catalogue as a count of its own."""
    lines = []
    for t in CATALOGUE:
        source = CTES[t.name]
        for name, bad, where, warn, err in t.rows:
            lines.append((t.name, name, f"SELECT count(*) FROM {source} WHERE ({bad}) AND ({where or 'true'})", warn, err))
        for c, hours in t.recent:
            lines.append((t.name, f"{c} within {hours} hours", f"SELECT CASE WHEN max({c}) >= TIMESTAMP '{NOW}' - INTERVAL {hours} HOUR THEN 0 ELSE 1 END FROM {source}", 1, 1))
        for key in t.keys:
            lines.append((t.name, f"unique {', '.join(key)}", f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {', '.join(key)} HAVING count(*) > 1)", 1, 1))
        for c, by, tolerance in t.sums:
            lines.append((t.name, f"{c} sums to 100 by {', '.join(by)}", f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {', '.join(by)} HAVING round(abs(sum({c}) - 100), 9) > {tolerance})", 1, 1))
        for c, (p, pc) in t.references:
            lines.append((t.name, f"{c} in {p}.{pc}", f"SELECT count(*) FROM {source} WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {pc} FROM {CTES[p]} WHERE {pc} IS NOT NULL)", 1, 1))
        for keys, ts, dataset in t.gaps:
            over = f"{'PARTITION BY ' + ', '.join(keys) if keys else ''} ORDER BY {ts}"
            holes = f"SELECT {ts} + INTERVAL 30 MINUTE AS a, lead({ts}) OVER ({over}) AS z FROM (SELECT DISTINCT {', '.join([*keys, ts])} FROM {source})"
            known = f" AND NOT EXISTS (SELECT 1 FROM known k WHERE k.dataset = '{dataset}' AND g.a >= k.start_ts AND g.z <= k.end_ts)" if dataset else ""
            lines.append((t.name, f"no gaps in {ts}{' by ' + ', '.join(keys) if keys else ''}", f"SELECT count(*) FROM ({holes}) g WHERE z > a{known}", 1, 1))
    quoted = lambda x: x.replace("'", "''")
    rows = " UNION ALL ".join(f"SELECT '{t}' AS table_name, '{quoted(n)}' AS check_name, ({q}) AS failures, {warn} AS w, {err} AS e" for t, n, q, warn, err in lines)
    return f"(SELECT table_name, check_name, failures, CASE WHEN failures >= e THEN 'error' WHEN failures >= w THEN 'warn' ELSE 'pass' END AS status FROM ({rows}))"


add("qc17_catalogue", "table_name check_name failures:i status", lambda w: quality.run_catalogue(CATALOGUE, tables(w), w.raw.known_gaps, fn.as_of(NOW)), oracle())
