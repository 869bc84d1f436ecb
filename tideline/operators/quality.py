"""Data checks: each takes a DataFrame and returns the rows (or groups) that break a rule."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import intervals


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Values below low or above high; nulls pass."""
    bad = F.lit(False)
    bad = bad | (F.col(column) < low) if low is not None else bad
    bad = bad | (F.col(column) > high) if high is not None else bad
    return df.filter(bad)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.filter(~F.col(column).isin(*values))


def aligned(df: DataFrame, column: str) -> DataFrame:
    """Times that aren't on a half-hour."""
    fraction = F.date_format(column, "mm:ss.SSSSSS")
    return df.filter(~fraction.isin("00:00.000000", "30:00.000000"))


def unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def foreign_key(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.filter(F.col(column).isNotNull()).join(keys, column, "left_anti")


def shares_sum(df: DataFrame, column: str, by: Sequence[str], tolerance: float = 1.5) -> DataFrame:
    """Groups whose sum differs from 100 by more than the tolerance; compared in 9 places, as sums differ beyond them by the order of rows."""
    return df.groupBy(*by).agg(F.sum(column).alias("total")).filter(F.round(F.abs(F.col("total") - 100), 9) > tolerance)


def unexpected_gaps(df: DataFrame, keys: Sequence[str], ts: str, known: DataFrame | None = None, dataset: str | None = None) -> DataFrame:
    """Holes that no known interval (dataset, start_ts, end_ts) of the same dataset contains.

    A known interval is dealt to its days, and a hole looked up by the day on which it begins.
    """
    found = intervals.gaps(df, keys, ts)
    if known is None:
        return found
    mine = known if dataset is None else known.filter(F.col("dataset") == dataset)
    days = F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts")))
    k = mine.select(days.alias("k_day"), F.col("start_ts").alias("k_start"), F.col("end_ts").alias("k_end"))
    inside = (F.to_date("start_ts") == F.col("k_day")) & (F.col("start_ts") >= F.col("k_start")) & (F.col("end_ts") <= F.col("k_end"))
    return found.join(k, inside, "left_anti")


def stale(df: DataFrame, column: str, hours: int, now) -> DataFrame:
    """One row with the newest time if it is older than `hours` before now, or if there is none."""
    return df.agg(F.max(column).alias("newest")).filter(F.col("newest").isNull() | (F.col("newest") < now - F.expr(f"INTERVAL {hours} HOURS")))


def calendar_covered(days: DataFrame, day: str, listed: DataFrame, listed_day: str, years_ahead: int = 0) -> DataFrame:
    """One row if the list's last year doesn't reach the calendar's last year plus years_ahead, or its first begins too late."""
    span = days.agg(F.min(F.year(day)).alias("first_year"), (F.max(F.year(day)) + years_ahead).alias("last_year"))
    have = listed.agg(F.min(F.year(listed_day)).alias("list_first"), F.max(F.year(listed_day)).alias("list_last"))
    return span.crossJoin(F.broadcast(have)).filter("list_first is null or list_first > first_year or list_last < last_year")


def lagging(df: DataFrame, group: str, year: str, behind: int = 2) -> DataFrame:
    """Groups whose last year lies more than `behind` before the newest of all."""
    last = df.groupBy(group).agg(F.max(year).alias("latest"))
    return last.crossJoin(F.broadcast(last.agg(F.max("latest").alias("newest")))).filter(F.col("latest") < F.col("newest") - behind)


def disagrees(df: DataFrame, stated: str, derived, tolerance: float = 0.02) -> DataFrame:
    """Rows whose stated value differs from the derived one by more than the tolerance, relatively."""
    out = df.withColumn("derived", derived)
    return out.filter(F.abs(F.col(stated) - F.col("derived")) > tolerance * F.abs(F.col("derived")))


def beaten(df: DataFrame, best: str, others: Sequence[str], slack: float = 1e-9) -> DataFrame:
    """Rows in which the supposed best (lowest) is above another column."""
    return df.filter(F.col(best) > F.least(*others) + slack)


def bad_window(df: DataFrame) -> DataFrame:
    return df.filter("start_date > end_date or start_date is null or end_date is null")


@dataclass(frozen=True)
class Check:
    """A named set of failures with the counts at which it warns and errs."""

    name: str
    failures: DataFrame
    warn_if: int = 1
    error_if: int = 1


@dataclass(frozen=True)
class Rule:
    """What every row of a table has to satisfy (null: satisfied), among those rows that `where` picks."""

    name: str
    holds: Column
    where: Column | None = None
    warn_if: int = 1
    error_if: int = 1


def _status(failures: Column, c: Check | Rule) -> Column:
    return F.when(failures >= c.error_if, "error").when(failures >= c.warn_if, "warn").otherwise("pass")


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(check_name, failures, status) of all rules over one table, in one scan."""
    counts = df.agg(*(F.count_if((F.lit(True) if r.where is None else r.where) & ~r.holds).alias(f"c{k}") for k, r in enumerate(rules)))
    rows = F.array(*(F.struct(F.lit(r.name).alias("check_name"), F.col(f"c{k}").alias("failures"), _status(F.col(f"c{k}"), r).alias("status")) for k, r in enumerate(rules)))
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def run_suite(checks: Sequence[Check]) -> DataFrame:
    """(check_name, failures, status): one row for each check."""

    def row(c: Check) -> DataFrame:
        counted = c.failures.agg(F.count(F.lit(1)).alias("failures"))
        return counted.select(F.lit(c.name).alias("check_name"), "failures", _status(F.col("failures"), c).alias("status"))

    return reduce(DataFrame.unionByName, map(row, checks))


@dataclass(frozen=True)
class Table:
    """What holds of a table: rows (name -> condition that a row breaks, as SQL), keys, references and gaps.

    rows: (name, broken when, among rows where, warns from, errs from). keys: column lists whose values don't repeat. references:
    column -> (table, column) that its values stand in. sums: (column, by, tolerance) that add up to 100. gaps: (key columns, time,
    dataset of the known gaps or None). recent: (time, hours).
    """

    name: str
    rows: tuple[tuple[str, str, str | None, int, int], ...] = ()
    keys: tuple[tuple[str, ...], ...] = ()
    references: tuple[tuple[str, tuple[str, str]], ...] = ()
    sums: tuple[tuple[str, tuple[str, ...], float], ...] = ()
    gaps: tuple[tuple[tuple[str, ...], str, str | None], ...] = ()
    recent: tuple[tuple[str, int], ...] = ()


def _named(counts: DataFrame, names: Sequence[tuple[str, Column, int, int]]) -> DataFrame:
    """One row of counts -> (check_name, failures, status) rows."""
    rows = (F.struct(F.lit(n).alias("check_name"), F.coalesce(c, F.lit(0)).cast("long").alias("failures"), F.lit(warn).alias("warn"), F.lit(err).alias("err")) for n, c, warn, err in names)
    out = counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("check_name", "failures", F.when(F.col("failures") >= F.col("err"), "error").when(F.col("failures") >= F.col("warn"), "warn").otherwise("pass").alias("status"))


def compiled(t: Table, df: DataFrame, tables: dict[str, DataFrame], known_gaps: DataFrame | None = None, now: Column | None = None) -> list[DataFrame]:
    """The checks of one table as few plans, each one scan of it: all row conditions and times together, all keys that begin alike by one
    grouping, all references by one exploded lookup, gaps by series.
    """
    out = []
    if t.rows or t.recent:
        broken = [F.count_if((F.lit(True) if where is None else F.expr(where)) & F.expr(bad)) for _, bad, where, _, _ in t.rows]
        old = [F.when(F.max(c).isNull() | (F.max(c) < now - F.expr(f"INTERVAL {hours} HOURS")), 1).otherwise(0) for c, hours in t.recent]
        counts = df.agg(*(c.alias(f"c{i}") for i, c in enumerate([*broken, *old])))
        names = [(n, warn, err) for n, _, _, warn, err in t.rows] + [(f"{c} within {h} hours", 1, 1) for c, h in t.recent]
        out.append(_named(counts, [(n, F.col(f"c{i}"), warn, err) for i, (n, warn, err) in enumerate(names)]))
    sums = {by: (column, tolerance) for column, by, tolerance in t.sums}
    for key in t.keys:
        inner = [by for by in sums if key[: len(by)] == by]  # groups of this key's groups
        first = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *(F.sum(sums[by][0]).alias(f"_s{i}") for i, by in enumerate(inner)))
        names = [(f"unique {', '.join(key)}", F.col("_repeated"), 1, 1)]
        if inner:
            by = inner[0]
            second = first.groupBy(*by).agg(F.count_if(F.col("_n") > 1).alias("_r"), F.sum("_s0").alias("_t"))
            counts = second.agg(F.sum("_r").alias("_repeated"), F.count_if(F.round(F.abs(F.col("_t") - 100), 9) > sums[by][1]).alias("_off"))
            names.append((f"{sums[by][0]} sums to 100 by {', '.join(by)}", F.col("_off"), 1, 1))
        else:
            counts = first.agg(F.count_if(F.col("_n") > 1).alias("_repeated"))
        out.append(_named(counts, names))
    if t.references:
        looked = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c, _ in t.references))).alias("x")
        found = df.select(looked).select("x.*").filter("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        parents = reduce(DataFrame.unionByName, (tables[p].select(F.lit(c).alias("column"), F.col(pc).cast("string").alias("value")) for c, (p, pc) in t.references))
        lost = found.join(parents.distinct(), ["column", "value"], "left_anti")
        counts = lost.agg(*(F.sum(F.when(F.col("column") == c, F.col("n"))).alias(f"c{i}") for i, (c, _) in enumerate(t.references)))
        out.append(_named(counts, [(f"{c} in {p}.{pc}", F.col(f"c{i}"), 1, 1) for i, (c, (p, pc)) in enumerate(t.references)]))
    for keys, ts, dataset in t.gaps:
        missing = unexpected_gaps(df, list(keys), ts, known_gaps if dataset else None, dataset)
        out.append(_named(missing.agg(F.count(F.lit(1)).alias("c")), [(f"no gaps in {ts}{' by ' + ', '.join(keys) if keys else ''}", F.col("c"), 1, 1)]))
    return out


def run_catalogue(catalogue: Sequence[Table], tables: dict[str, DataFrame], known_gaps: DataFrame, now: Column) -> DataFrame:
    """(table_name, check_name, failures, status), a row for every line of the catalogue."""
    parts = [p.select(F.lit(t.name).alias("table_name"), "*") for t in catalogue for p in compiled(t, tables[t.name], tables, known_gaps, now)]
    return reduce(DataFrame.unionByName, parts)
