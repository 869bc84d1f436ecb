"""The tables at hand read as the raw datasets of a half-hourly energy feed.

Events become the national series, its mix and its regions; orders become yearly country data and a long daily series.
Sums are taken in whole numbers, so that another engine gets the same values to the last bit.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timefn as fn

# Fixed values of the binding.
SHIFT_DAYS = 70  # moves the events onto a clock change, a month's end and public holidays
KINDS = {"view": "gas", "click": "wind", "signup": "solar", "error": "nuclear", "purchase": "imports"}
PUBLISHED = ("click", "view", "signup")  # the kinds that the source's own forecast is made from
FUELS = [
    # fuel, label, category, fossil, renewable, low carbon, order
    ("gas", "Gas", "Fossil", True, False, False, 1),
    ("coal", "Coal", "Fossil", True, False, False, 2),
    ("other", "Other", "Other", False, False, False, 3),
    ("imports", "Imports", "Imports", False, False, False, 4),
    ("biomass", "Biomass", "Renewable", False, True, True, 5),
    ("nuclear", "Nuclear", "Nuclear", False, False, True, 6),
    ("hydro", "Hydro", "Renewable", False, True, True, 7),
    ("wind", "Wind", "Renewable", False, True, True, 8),
    ("solar", "Solar", "Renewable", False, True, True, 9),
]
FUEL_NAMES = [f[0] for f in FUELS]
REGIONS = 18  # the last one is the aggregate
HOLIDAYS = [("2024-03-29", "Good Friday"), ("2024-04-01", "Easter Monday"), ("2024-04-01", "Easter holiday"), ("2024-05-06", "Early May")]
KNOWN_GAPS = [("regional", "2024-03-20 00:00:00", "2024-03-21 00:00:00"), ("regional", "2024-03-27 18:00:00", "2024-03-29 06:00:00"), ("national", "2024-04-02 00:00:00", "2024-04-04 00:00:00")]
PRIORITIES = {"1-URGENT": ("Gas", 490), "2-HIGH": ("Coal", 820), "3-MEDIUM": ("Wind", 11), "4-NOT SPECIFIED": ("Solar", 45), "5-LOW": ("Nuclear", 12)}
GROUPS = ("GCC", "UK", "EU", "Benchmark", "Other")  # by number of the nation's region


def choose(column, mapping: dict):
    """column mapped through a fixed dictionary; null for other values."""
    out = F.lit(None)
    for k, v in mapping.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def index_of(value):
    """Five named bands of a value."""
    return F.when(value < 100, "very low").when(value < 200, "low").when(value < 300, "moderate").when(value < 400, "high").when(value.isNotNull(), "very high")


class Bound:
    """The raw datasets, as lazy DataFrames over the tables in a directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def events(self) -> DataFrame:
        raw = self.table("events").select("user_id", "event_type", "value", (F.col("ts").cast("timestamp_ntz") + F.expr(f"INTERVAL {SHIFT_DAYS} DAYS")).alias("ts"))
        return raw.select(fn.floor_half_hour("ts").alias("ts"), (F.col("user_id") % REGIONS + 1).cast("int").alias("region_id"), "event_type", F.round(F.col("value") * 100).cast("long").alias("cents"))

    @staticmethod
    def _mean(of):
        cents, n = F.sum(F.when(of, F.col("cents"))), F.sum(F.when(of, 1).otherwise(0))
        return F.call_function("div", cents, F.nullif(100 * n, F.lit(0))).cast("int")

    @cached_property
    def national(self) -> DataFrame:
        every, published = F.lit(True), F.col("event_type").isin(*PUBLISHED)
        out = self.events.groupBy("ts").agg(self._mean(published).alias("forecast"), self._mean(every).alias("actual"))
        return out.withColumn("band", index_of(F.col("actual")))

    @cached_property
    def mix(self) -> DataFrame:
        n = self.events.groupBy("ts", "event_type").agg(F.count(F.lit(1)).alias("n"))
        total = self.events.groupBy("ts").agg(F.count(F.lit(1)).alias("total"))
        return n.join(total, "ts").select("ts", choose(F.col("event_type"), KINDS).alias("fuel"), (F.lit(100.0) * F.col("n") / F.col("total")).alias("share"))

    @cached_property
    def regional(self) -> DataFrame:
        out = self.events.groupBy("ts", "region_id").agg(self._mean(F.lit(True)).alias("forecast"))
        return out.withColumn("band", index_of(F.col("forecast")))

    @cached_property
    def regional_mix(self) -> DataFrame:
        n = self.events.groupBy("ts", "region_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
        total = self.events.groupBy("ts", "region_id").agg(F.count(F.lit(1)).alias("total"))
        return n.join(total, ["ts", "region_id"]).select("ts", "region_id", choose(F.col("event_type"), KINDS).alias("fuel"), (F.lit(100.0) * F.col("n") / F.col("total")).alias("share"))

    @cached_property
    def snapshots(self) -> DataFrame:
        """Issued each midnight for the half-hours -1 to 96 ahead: the value of two days before."""
        days = self.national.select(F.to_date("ts").cast("timestamp_ntz").alias("issued")).distinct()
        pairs = days.withColumn("h", F.explode(F.sequence(F.lit(-1), F.lit(96)))).withColumn("ts", F.timestamp_add("MINUTE", F.col("h") * 30, F.col("issued")))
        past = self.national.select((F.col("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"), F.col("actual").alias("forecast"))
        return pairs.join(past, "ts").select("issued", "ts", "forecast")

    @cached_property
    def yearly(self) -> DataFrame:
        """area, code (blank ones null), year, source, generation, share, emissions, intensity, with a total for each area and year."""
        orders, customers, nations = self.table("orders"), self.table("customer"), self.table("nation")
        # customers grow with the orders, so they are merged and don't pass the driver; what follows reads that join once
        cents = orders.join(customers.select("c_custkey", "c_nationkey").hint("merge"), orders.o_custkey == customers.c_custkey).groupBy("c_nationkey", F.year("o_orderdate").alias("year"), "o_orderpriority").agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
        cents = cents.join(F.broadcast(nations), cents.c_nationkey == nations.n_nationkey)
        each = cents.select(F.col("n_name").alias("area"), "n_regionkey", "year", choose(F.col("o_orderpriority"), {k: v[0] for k, v in PRIORITIES.items()}).alias("source"), "cents", (F.col("cents") * choose(F.col("o_orderpriority"), {k: v[1] for k, v in PRIORITIES.items()})).alias("grams"))
        whole = each.groupBy("area", "n_regionkey", "year").agg(F.collect_list(F.struct("source", "cents", "grams")).alias("parts"), F.sum("cents").alias("total_cents"), F.sum("grams").alias("grams"))  # a part a source
        total = F.struct(F.lit("Total generation").alias("source"), F.col("total_cents").alias("cents"), "grams")
        rows = whole.select("area", "n_regionkey", "year", "total_cents", F.explode(F.array_append("parts", total)).alias("x")).select("area", "n_regionkey", "year", "total_cents", "x.*")
        return rows.select(
            "area", F.nullif(F.when(F.col("n_regionkey") == 2, F.lit("")).otherwise(F.upper(F.substring("area", 1, 3))), F.lit("")).alias("code"), "year", "source", (F.col("source") == "Total generation").alias("is_total"), (F.col("cents") / 1e8).alias("generation"),
            (F.lit(100.0) * F.col("cents") / F.col("total_cents")).alias("share"), (F.col("grams") / 1e11).alias("emissions"), (F.col("grams") / F.col("cents")).alias("intensity"),
        )

    @cached_property
    def countries(self) -> DataFrame:
        n = self.table("nation")
        return n.select(F.col("n_name").alias("area"), F.format_string("C%02d", F.col("n_nationkey").cast("int")).alias("country"), F.element_at(F.array(*map(F.lit, GROUPS)), (F.col("n_regionkey") + 1).cast("int")).alias("peer_group"), F.col("n_nationkey").cast("int").alias("sort_order"))

    @cached_property
    def fuels(self) -> DataFrame:
        return self.spark.createDataFrame(FUELS, "fuel string, label string, category string, is_fossil boolean, is_renewable boolean, is_low_carbon boolean, sort_order int")

    @cached_property
    def regions(self) -> DataFrame:
        return self.spark.range(1, REGIONS + 1).select(F.col("id").cast("int").alias("region_id"), F.format_string("Region %d", "id").alias("region"), F.when(F.col("id") <= 14, "Mainland").otherwise("Aggregate").alias("nation"), (F.col("id") > 14).alias("is_aggregate"))

    @cached_property
    def holidays(self) -> DataFrame:
        return self.spark.createDataFrame(HOLIDAYS, "day string, name string").select(F.to_date("day").alias("day"), "name")

    @cached_property
    def known_gaps(self) -> DataFrame:
        return self.spark.createDataFrame(KNOWN_GAPS, "dataset string, a string, b string").select("dataset", F.col("a").cast("timestamp_ntz").alias("start_ts"), F.col("b").cast("timestamp_ntz").alias("end_ts"))

    @cached_property
    def daily_orders(self) -> DataFrame:
        """A long daily series: mean order value and number of orders for each day."""
        o = self.table("orders").select(F.to_date("o_orderdate").alias("day"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
        return o.groupBy("day").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("orders")).select("day", "orders", (F.col("cents") / (100 * F.col("orders"))).alias("value"))
