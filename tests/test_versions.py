"""Snapshots of upserted tables, writers against each other, restores and digests."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tideline.operators import upsert, versions


def ts(text):
    return dt.datetime.fromisoformat(text)


A, B, C = ts("2024-01-31T23:30"), ts("2024-02-01T00:00"), ts("2024-03-05T12:00")


@pytest.fixture
def table(spark, tmp_path):
    """(path, merge rows, the rows as (ts, v))"""
    path = str(tmp_path / "table")
    put = lambda *rows: upsert.upsert(spark, path, spark.createDataFrame(rows, "ts timestamp_ntz, v int"), ["ts"], "ts")
    return path, put, lambda df=None: sorted(map(tuple, (upsert.rows_of(spark, path) if df is None else df).collect()))


def test_a_reader_keeps_its_snapshot(spark, table, monkeypatch):
    """Opened before the upsert, in the middle of it, and by number afterwards."""
    path, put, shown = table
    put((A, 1), (B, 2), (C, 3))
    opened, middle = upsert.rows_of(spark, path), []
    plain = versions.commit

    def commit(*a):
        middle.append(shown())
        return plain(*a)

    monkeypatch.setattr(versions, "commit", commit)
    assert put((B, 20), (C, 3)) == {"inserted": 0, "updated": 1, "unchanged": 1, "months": ["2024-02"]}
    old = [(A, 1), (B, 2), (C, 3)]
    assert middle == [old] and shown(opened) == old == shown(versions.read(spark, path, version=1)) and shown() == [(A, 1), (B, 20), (C, 3)]
    first, second = (versions.months(spark, path, v) for v in (1, 2))
    assert first["2024-01"] == second["2024-01"] and first["2024-02"] != second["2024-02"]  # only that month was written again
    assert put((A, 1)) == {"inserted": 0, "updated": 0, "unchanged": 1, "months": []} and versions.newest(spark, path) == 2


def test_the_second_writer_is_refused(spark, table, monkeypatch):
    path, put, shown = table
    put((A, 1), (B, 2))
    plain = versions.write_months

    def overtaken(*a):
        monkeypatch.setattr(versions, "write_months", plain)
        put((A, 5))  # another writer, from the same version, is faster
        return plain(*a)

    monkeypatch.setattr(versions, "write_months", overtaken)
    with pytest.raises(versions.ConcurrentWrite):
        put((B, 9))
    assert shown() == [(A, 5), (B, 2)] and versions.versions(spark, path) == [1, 2]
    put((B, 9))
    assert shown() == [(A, 5), (B, 9)]
    assert not [n for n in os.listdir(f"{path}/log") if n.endswith(".part")]


def test_a_writer_that_stops_changes_nothing(spark, table, monkeypatch):
    path, put, shown = table
    put((A, 1), (B, 2))
    with monkeypatch.context() as m:
        m.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            put((A, 7), (C, 7))
    assert shown() == [(A, 1), (B, 2)]
    put((C, 3))
    put((A, 4))
    with pytest.raises(ValueError):
        put((None, 1))
    assert shown() == [(A, 4), (B, 2), (C, 3)] and len(os.listdir(f"{path}/data")) == 4
    assert versions.vacuum(spark, path) == 0  # all are younger than a day
    assert versions.vacuum(spark, path, keep=2, grace_s=-1) == 1  # the lost writer's
    assert shown(versions.read(spark, path, version=2)) == [(A, 1), (B, 2), (C, 3)]
    versions.vacuum(spark, path, grace_s=-1)
    assert versions.versions(spark, path) == [3] and shown() == [(A, 4), (B, 2), (C, 3)]
    put((B, 8))
    assert versions.newest(spark, path) == 4 and shown() == [(A, 4), (B, 8), (C, 3)]


def test_a_table_without_rows(spark, table):
    path, put, shown = table
    assert upsert.rows_of(spark, path, "ts timestamp_ntz, v int").count() == 0
    assert put()["months"] == [] and versions.newest(spark, path) == 0


def test_nothing_published_is_no_error(spark, tmp_path):
    rows = spark.createDataFrame([(A, 1), (B, 2)], "ts timestamp_ntz, v int")
    place, table = str(tmp_path / "site"), str(tmp_path / "table")
    again = lambda: upsert.restore_published(spark, place, table, ["ts"], "ts")
    assert upsert.publish(rows.filter("false"), place) == 0 and again() == {"status": "no-mirror"}
    assert upsert.publish(rows, place) == 2
    assert again()["inserted"] == 2 and again() == {"status": "restored", "inserted": 0, "updated": 0, "unchanged": 2, "months": []}
    with pytest.raises(ValueError):
        upsert.restore(spark, spark.read.json(f"{place}/manifest").filter("false"), f"{place}/files", table, ["ts"], "ts")


def test_large_files_are_hashed_as_streams(spark, tmp_path):
    """The same digests from rows and from streams; a file without bytes isn't listed."""
    for name, content in (("a", b""), ("b", b"x" * 5000), ("c", os.urandom(3 << 20))):
        (tmp_path / name).write_bytes(content)
    with (tmp_path / "d").open("wb") as f:
        f.truncate(40 << 20)
    want = {n: hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n in "bcd"}
    for whole in (1000, 1 << 20, 64 << 20):
        found = {r.path[-1]: (r.bytes, r.sha256) for r in upsert.file_manifest(spark, str(tmp_path), whole=whole).collect()}
        assert {n: s for n, (_, s) in found.items()} == want and found["d"][0] == 40 << 20


def test_refresh_passes_on_what_isnt_the_files_fault(spark, tmp_path):
    landed, table = tmp_path / "f.csv", str(tmp_path / "table")
    landed.write_text("a\n1\n")
    read = lambda path: spark.read.option("header", True).csv(path)
    assert upsert.refresh(spark, str(landed), table, read) == "replaced"
    landed.write_text("a\n2\n")
    with pytest.raises(OSError):
        upsert.refresh(spark, str(landed), table, lambda path: (_ for _ in ()).throw(OSError("disk full")))
    strict = lambda path: read(path).select(F.col("a").cast("int"), F.col("b"))
    assert upsert.refresh(spark, str(landed), table, strict) == "kept"
    assert [r.a for r in upsert.current(spark, table).collect()] == ["1"]
