"""Measures that hold in any filter context, from one table of mergeable states.

A state row stands for a day, half-hour slot and member (a region, or the nation): sums, weights and counts, which add up. A measure of a
context (a month, a member, both, or all) is a ratio of its states' sums; the slot with the lowest mean is found from the same states, added
up by slot first. So facts are aggregated once, whatever contexts are asked for, and totals are right: they are no means of means.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.series import pick_lowest
from .catalog import add
from .warehouse import Warehouse

NATION = "nation"
_SUMS = ("n", "total", "error_n", "error_total", "ape_n", "ape_total", "peak_n", "peak_total", "low_carbon_n", "low_carbon_total")


def states(w: Warehouse) -> DataFrame:
    """(day, month, time_key, label, member, is_region, sums): a row for each day, slot and member."""
    slots = F.broadcast(w.dim_time.select("time_key", "label", "is_evening_peak"))
    nation = w._dated(w.national).select("day", "time_key", F.lit(NATION).alias("member"), F.lit(False).alias("is_region"), F.col("actual").cast("double").alias("value"), F.col("error").cast("double").alias("error"), "low_carbon_pct")
    regions = w._dated(w.regional).select("day", "time_key", F.col("region_id").cast("string").alias("member"), F.lit(True).alias("is_region"), F.col("forecast").cast("double").alias("value"), F.lit(None).cast("double").alias("error"), F.lit(None).cast("double").alias("low_carbon_pct"))
    rows = nation.unionByName(regions).join(slots, "time_key")
    v, e = F.col("value"), F.abs("error")
    parts = {"": v, "error_": e, "ape_": F.when(v > 0, e / v), "peak_": F.when(F.col("is_evening_peak"), v), "low_carbon_": F.col("low_carbon_pct")}
    sums = [x for name, c in parts.items() for x in (F.count(c).alias(f"{name}n"), F.sum(c).alias(f"{name}total"))]
    return rows.groupBy("day", F.trunc("day", "month").alias("month"), "time_key", "label", "member", "is_region").agg(*sums)


def ratio(name: str) -> Column:
    return F.col(f"{name}total") / F.nullif(F.col(f"{name}n"), F.lit(0))


def measured(state: DataFrame, contexts: Sequence[Sequence[str]], by: Sequence[str]) -> DataFrame:
    """(by, periods, measures) of every context, a set of the columns `by`; those not in it are null and stand for all.

    Slots are kept through the first rollup, so that the lowest one is taken from the context's own sums.
    """
    by = list(by)
    of_slot = state.groupingSets([[*c, "label"] for c in contexts], *by, "label").agg(F.grouping_id().alias("_g"), *(F.sum(c).alias(c) for c in _SUMS))
    bits = F.shiftright("_g", 1).alias("context")  # label is the last column and always grouped
    of_slot = of_slot.select(*by, "label", bits, *_SUMS).withColumn("mean", ratio(""))
    out = of_slot.groupBy(*by, "context").agg(*(F.sum(c).alias(c) for c in _SUMS), pick_lowest("label", "mean").alias("lowest_half_hour"))
    peak = F.lit(100.0) * ratio("peak_") / ratio("") - 100
    return out.select(*by, F.col("n").alias("periods"), ratio("").alias("mean_value"), ratio("error_").alias("mae"), (100 * ratio("ape_")).alias("mape_pct"), ratio("low_carbon_").alias("low_carbon_pct"), peak.alias("evening_premium_pct"), "lowest_half_hour")


CONTEXTS = (("is_region", "member", "month"), ("is_region", "member"), ("is_region", "month"), ("is_region",))


def in_contexts(w: Warehouse) -> DataFrame:
    """Each measure by month and member, by member, by month over the nation or over all regions, and overall."""
    return measured(states(w), CONTEXTS, ("is_region", "member", "month"))


_MEASURES = """count(value) AS periods, avg(value) AS mean_value, avg(abs(error)) AS mae, 100.0 * avg(abs(error) / value) FILTER (value > 0) AS mape_pct, avg(low_carbon_pct) AS low_carbon_pct,
  100.0 * avg(value) FILTER (is_evening_peak) / avg(value) - 100 AS evening_premium_pct"""
_FACTS = """f AS (SELECT false AS is_region, 'nation' AS member, CAST(date_trunc('month', day) AS DATE) AS month, label, is_evening_peak, CAST(actual AS DOUBLE) AS value, error, low_carbon_pct FROM fn JOIN dd USING (date_key) JOIN dt USING (time_key)
  UNION ALL SELECT true, CAST(region_id AS VARCHAR), CAST(date_trunc('month', day) AS DATE), label, is_evening_peak, CAST(forecast AS DOUBLE), NULL, NULL FROM freg JOIN dd USING (date_key) JOIN dt USING (time_key))"""


def _context(columns: Sequence[str]) -> str:
    """A context's measures, straight from the facts."""
    shown = ", ".join(c if c in columns else f"CAST(NULL AS {'DATE' if c == 'month' else 'VARCHAR'}) AS {c}" for c in ("is_region", "member", "month"))
    keys = ", ".join(columns)
    return f"SELECT {shown}, b.* EXCLUDE ({keys}), lowest_half_hour FROM (SELECT {keys}, {_MEASURES} FROM f GROUP BY {keys}) b JOIN (SELECT {keys}, arg_min(label, (m, label)) AS lowest_half_hour FROM (SELECT {keys}, label, avg(value) AS m FROM f GROUP BY {keys}, label) WHERE m IS NOT NULL GROUP BY {keys}) l USING ({keys})"


add("q34_measures_in_contexts", "is_region member month periods:i mean_value:f mae:f mape_pct:f low_carbon_pct:f evening_premium_pct:f lowest_half_hour", in_contexts, f"(WITH {_FACTS} " + " UNION ALL ".join(map(_context, CONTEXTS)) + ")")
