"""Typed readers of landed files: month-partitioned Parquet, strict CSV, nested JSON documents with validation."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timefn as fn
from ..operators.upsert import rows_of


@dataclass(frozen=True)
class Dataset:
    """A raw table: its schema, key, time column, and the columns that don't count when rows are compared."""

    schema: str
    keys: tuple[str, ...]
    ts: str
    metadata: tuple[str, ...] = field(default=("fetched_at",))

    def struct(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.struct())

    def scan(self, spark: SparkSession, path: str) -> DataFrame:
        """The rows of the table's newest version; typed but empty where there is none yet."""
        return rows_of(spark, path, self.struct())


NATIONAL = Dataset("ts timestamp_ntz, end_ts timestamp_ntz, forecast int, actual int, band string, fetched_at timestamp_ntz", ("ts",), "ts")
MIX = Dataset("ts timestamp_ntz, end_ts timestamp_ntz, fuel string, share double, fetched_at timestamp_ntz", ("ts", "fuel"), "ts")
REGIONAL = Dataset("ts timestamp_ntz, end_ts timestamp_ntz, region_id int, forecast int, band string, fetched_at timestamp_ntz", ("ts", "region_id"), "ts")
REGIONAL_MIX = Dataset("ts timestamp_ntz, region_id int, fuel string, share double, fetched_at timestamp_ntz", ("ts", "region_id", "fuel"), "ts")
SNAPSHOTS = Dataset("issued timestamp_ntz, ts timestamp_ntz, end_ts timestamp_ntz, forecast int, band string, fetched_at timestamp_ntz", ("issued", "ts"), "ts")
BANDS = ("very low", "low", "moderate", "high", "very high")
FORMAT = "yyyy-MM-dd'T'HH:mm'Z'"


def bounds(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))


def distinct_times(df: DataFrame, ts: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.select(*keys, ts).distinct()


def clip(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """start <= ts < end."""
    return df.filter((F.col(ts) >= F.lit(start).cast("timestamp_ntz")) & (F.col(ts) < F.lit(end).cast("timestamp_ntz")))


def strict_csv(spark: SparkSession, path: str, columns: dict[str, tuple[str, str]], required: Sequence[str]) -> DataFrame:
    """A CSV with a header as typed rows: trimmed, blanks null, true/false to boolean, strict casts; never inferred.

    columns: source name -> (name, type). A missing column, an empty file or a null in `required` is an error.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = set(columns) - set(raw.columns)
    if missing:
        raise ValueError(f"missing columns: {sorted(missing)}")

    def typed(source: str, name: str, kind: str) -> Column:
        c = F.nullif(F.trim(F.col(f"`{source}`")), F.lit(""))
        if kind == "boolean":
            return F.when(F.lower(c) == "true", True).when(F.lower(c) == "false", False).alias(name)
        return c.cast(kind).alias(name)

    out = raw.select(*(typed(s, n, k) for s, (n, k) in columns.items()))
    counts = out.agg(F.count(F.lit(1)).alias("rows"), *(F.sum(F.col(c).isNull().cast("long")).alias(c) for c in required)).first()
    if not counts["rows"]:
        raise ValueError("the file has no rows")
    if any(counts[c] for c in required):
        raise ValueError(f"nulls in {[c for c in required if counts[c]]}")
    return out.orderBy(*required)


# ---- nested documents ----

_LEVEL = "struct<forecast:string,actual:string,index:string>"
_FUELS = "array<struct<fuel:string,perc:string>>"
_REGIONS = f"array<struct<regionid:string,shortname:string,intensity:{_LEVEL},generationmix:{_FUELS}>>"
DOCUMENT = f"struct<error:struct<code:string,message:string>,data:array<struct<from:string,to:string,intensity:{_LEVEL},generationmix:{_FUELS},regions:{_REGIONS}>>>"


def _number(c: Column, kind: str) -> Column:
    return F.try_cast(c, kind) if hasattr(F, "try_cast") else c.try_cast(kind)


def _time(c: Column) -> Column:
    return F.when(c.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\dZ$"), F.try_to_timestamp(c, F.lit(FORMAT)).cast("timestamp_ntz"))


def periods(texts: DataFrame, body: str = "body") -> DataFrame:
    """A row for each period of each JSON document (other columns stay), with the problems that it has.

    Problems are codes: error_document, no_data, bad_time, not_half_hour, bad_number, bad_index, bad_share.
    """
    others = [c for c in texts.columns if c != body]
    doc = texts.select(*others, F.from_json(body, DOCUMENT.removeprefix("struct<").removesuffix(">").replace("error:", "error ", 1).replace(",data:", ", data ", 1)).alias("d"))
    rows = doc.select(*others, F.col("d.error").isNotNull().alias("_error"), F.col("d.data").isNull().alias("_none"), F.explode_outer("d.data").alias("p"))
    start, end = _time(F.col("p.from")), _time(F.col("p.to"))
    level = F.col("p.intensity")

    def bad_number(c: Column) -> Column:
        return c.isNotNull() & _number(c, "int").isNull()

    shares = F.col("p.generationmix")
    codes = {
        "error_document": F.col("_error"), "no_data": ~F.col("_error") & F.col("_none"), "bad_time": F.col("p").isNotNull() & (start.isNull() | end.isNull()),
        "not_half_hour": end != start + F.expr("INTERVAL 30 MINUTES"), "bad_number": bad_number(level["forecast"]) | bad_number(level["actual"]),
        "bad_index": level["index"].isNotNull() & ~level["index"].isin(*BANDS), "bad_share": F.exists(F.coalesce(shares, F.array().cast(_FUELS)), lambda m: _number(m.perc, "double").isNull()),
    }
    problems = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in codes.items())))
    return rows.select(*others, "p", start.alias("ts"), end.alias("end_ts"), problems.alias("problems"))


def good(rows: DataFrame, mode: str = "fail") -> DataFrame:
    """Rows without problems; in mode "fail" the first problem stops the query, in "quarantine" its row is left out."""
    if mode == "fail":
        problem = F.raise_error(F.concat(F.lit("bad record: "), F.concat_ws(",", "problems")))
        rows = rows.withColumn("problems", F.when(F.size("problems") > 0, F.array(problem.cast("string"))).otherwise(F.col("problems")))
    return rows.filter(F.size("problems") == 0).drop("problems")


def national_rows(rows: DataFrame) -> DataFrame:
    return rows.select("ts", "end_ts", _number(F.col("p.intensity.forecast"), "int").alias("forecast"), _number(F.col("p.intensity.actual"), "int").alias("actual"), F.col("p.intensity.index").alias("band"))


def mix_rows(rows: DataFrame) -> DataFrame:
    return rows.select("ts", "end_ts", F.explode("p.generationmix").alias("m")).select("ts", "end_ts", F.lower("m.fuel").alias("fuel"), _number(F.col("m.perc"), "double").alias("share"))


def regional_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Region intensities and region mixes: two projections of one exploded table."""
    each = rows.select("ts", "end_ts", F.explode("p.regions").alias("r"))
    region = _number(F.col("r.regionid"), "int").alias("region_id")
    level = each.select("ts", "end_ts", region, _number(F.col("r.intensity.forecast"), "int").alias("forecast"), F.col("r.intensity.index").alias("band"))
    mix = each.select("ts", region, F.explode("r.generationmix").alias("m")).select("ts", "region_id", F.lower("m.fuel").alias("fuel"), _number(F.col("m.perc"), "double").alias("share"))
    return level, mix


def snapshot_rows(rows: DataFrame, issued: Column) -> DataFrame:
    return national_rows(rows).drop("actual").withColumn("issued", issued)


def issued_now(rows: DataFrame, as_of: str, now: Column) -> DataFrame:
    """Snapshot rows stamped with the half-hour that the as-of time lies in; none where that time is over 30 minutes behind the clock."""
    at = F.lit(as_of).cast("timestamp_ntz")
    return rows.filter(now - at <= F.expr("INTERVAL 30 MINUTES")).withColumn("issued", fn.floor_half_hour(at))


def seed_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A small table kept as CSV, with declared types: another header, or a field that isn't of its type, is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(path)


def landed(df: DataFrame, by: Column, ts: str = "ts") -> DataFrame:
    """(day, body): half-hourly rows with struct columns packed into one JSON document for each group, as a feed would serve them."""
    stamp = F.date_format(ts, FORMAT)
    end = F.date_format(F.col(ts) + F.expr("INTERVAL 30 MINUTES"), FORMAT)
    rest = [c for c in df.columns if c != ts]
    row = F.struct(stamp.alias("from"), end.alias("to"), *rest)
    return df.groupBy(by.alias("day")).agg(F.to_json(F.struct(F.sort_array(F.collect_list(row)).alias("data"))).alias("body"))


def merge_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
