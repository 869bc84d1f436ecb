"""Outputs: ordered CSV with a row count, star-schema exports with a manifest, tables for results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, order: Sequence[str]) -> int:
    """Ordered CSV with a header; returns the rows written, counted while they are written (behind the sort, which samples its input)."""
    seen = Observation()
    df.orderBy(*order).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").option("header", True).csv(path)
    return int(seen.get["rows"])


def export_star(spark: SparkSession, tables: Mapping[str, tuple[DataFrame, Sequence[str]]], path: str) -> DataFrame:
    """Every named table as CSV, and a manifest (table, rows) beside them as JSON."""
    counts = [(name, write_csv(df, f"{path}/{name}", order)) for name, (df, order) in tables.items()]
    manifest = spark.createDataFrame(counts, "table string, rows long")
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return manifest


def materialise(df: DataFrame, name: str, as_table: bool) -> DataFrame:
    """A layer's model under a name: a view where it is cheap, a table where it is shared."""
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    df.createOrReplaceTempView(name)
    return df


def write_run(predictions: DataFrame, summaries: Mapping[str, DataFrame], path: str, cutoff: str, settings: str) -> None:
    """A validation run: its predictions and summaries, each row marked with the cutoff and settings that it belongs to."""
    for name, df in {"predictions": predictions, **summaries}.items():
        df.withColumns({"cutoff": F.lit(cutoff), "settings": F.lit(settings)}).write.mode("append").parquet(f"{path}/{name}")


def compare_runs(by_method: DataFrame, band: str = "24-48 h") -> DataFrame:
    """One row for each stored run with each method's MAE in a band."""
    rows = by_method.filter(F.col("band") == band)
    return rows.groupBy("cutoff", "settings").pivot("method", ["model", "persistence", "naive_yesterday", "naive_last_week", "api_forecast"]).agg(F.first("mae"))
