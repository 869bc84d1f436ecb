"""The check catalogue: seeded defects, thresholds, and one scan for each kind of check."""

import datetime as dt
import re

from pyspark.sql import functions as F

from tideline.functions import timefn as fn
from tideline.operators import quality
from tideline.plans import checks

T = quality.Table(
    "t",
    (checks.null("ts"), checks.within("share", 0, 90, err=3), checks.within("share", 0, 50, "fuel = 'a'"), checks.one_of("fuel", "'a', 'b', 'x'"), checks.aligned("ts")),
    (("ts", "fuel"),),
    (("fuel", ("fuels", "fuel")), ("region", ("regions", "id"))),
    (("share", ("ts",), 1.5),),
    ((("fuel",), "ts", None),),
    (("ts", 3),),
)


def at(slot, minute=0):
    return dt.datetime(2025, 5, 1) + dt.timedelta(minutes=30 * slot + minute)


def test_seeded_defects_are_counted_in_few_scans(spark, tmp_path):
    rows = [(at(0), "a", 40.0, 1), (at(0), "b", 60.0, 1), (at(1), "a", 60.0, 2), (at(1), "b", 95.0, None), (at(1), "b", 1.0, 9), (at(3), "b", 99.0, 1), (at(5, 7), "x", 100.0, 1), (None, "y", None, 1)]
    spark.createDataFrame(rows, "ts timestamp_ntz, fuel string, share double, region int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    tables = {"t": df, "fuels": spark.createDataFrame([("a",), ("b",)], "fuel string"), "regions": spark.createDataFrame([(1,), (2,)], "id int")}
    parts = quality.compiled(T, df, tables, None, fn.as_of("2025-05-01 03:00:00"))
    scans = [len(re.findall(r"FileScan parquet", p._jdf.queryExecution().executedPlan().toString())) for p in parts]
    assert scans[:3] == [1, 1, 1] and len(parts) == 4  # rows and times, keys and sums, references; then gaps
    found = {r.check_name: (r.failures, r.status) for p in parts for r in p.collect()}
    assert found == {
        "ts present": (1, "error"),
        "share in [0, 90]": (3, "error"),
        "share in [0, 50] where fuel = 'a'": (1, "error"),
        "fuel of the known values": (1, "error"),
        "ts on a half-hour": (1, "error"),
        "ts within 3 hours": (0, "pass"),
        "unique ts, fuel": (1, "error"),
        "share sums to 100 by ts": (1, "error"),
        "fuel in fuels.fuel": (2, "error"),
        "region in regions.id": (1, "error"),
        "no gaps in ts by fuel": (1, "error"),
    }
    late = quality.compiled(T, df, tables, None, fn.as_of("2025-05-02 03:00:00"))[0]
    assert late.filter("check_name = 'ts within 3 hours'").first().failures == 1
    assert quality.compiled(T, df.filter(F.col("share") < 95), tables, None, fn.as_of("2025-05-01 03:00:00"))[0].filter("check_name = 'share in [0, 90]'").first().status == "pass"


def test_every_kind_of_table_is_in_the_catalogue():
    names = {t.name for t in checks.CATALOGUE}
    assert names == set(checks.CTES) and len(names) == len(checks.CATALOGUE)
    assert sum(len(t.rows) + len(t.keys) + len(t.references) + len(t.sums) + len(t.gaps) + len(t.recent) for t in checks.CATALOGUE) == 87
