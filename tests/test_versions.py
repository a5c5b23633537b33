"""Versions appear as a whole or not at all, and rewrites leave other partitions' files alone."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from spindrift.sources.versions import VersionedTable

SCHEMA = "k long, v string, day date"


def table(spark, path):
    return VersionedTable(spark, f"{path}/t", SCHEMA, "day")


def rows_of(df):
    return sorted((r.k, r.v, r.day.day if r.day else None) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(k, v, dt.date(2024, 1, d) if d else None) for k, v, d in rows], SCHEMA)


def folders(path):
    return {os.path.join(d, x) for d, sub, _ in os.walk(f"{path}/t/data") for x in sub if x.startswith("_p=")}


def test_versions(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.log.latest() is None and t.read().count() == 0 and t.keep_days(3) is None
    assert t.replace(frame(spark, [(1, "a", 1), (2, "b", 2), (3, "c", 9)])) == 0
    old = t.read()
    before = folders(tmp_path)
    assert t.upsert(frame(spark, [(2, "B", 9), (4, "d", 9), (5, "e", None)]), ["k"]) == 1  # key 2 moves from day 2 to day 9
    assert rows_of(t.read()) == [(1, "a", 1), (2, "B", 9), (3, "c", 9), (4, "d", 9), (5, "e", None)]
    assert rows_of(old) == [(1, "a", 1), (2, "b", 2), (3, "c", 9)] == rows_of(t.read(version=0))
    assert {f.rpartition("_p=")[2] for f in folders(tmp_path) - before} == {"2024-01-09", "__null__"}
    assert rows_of(t.read(low="2024-01-02", high="2024-01-31")) == [(2, "B", 9), (3, "c", 9), (4, "d", 9)]
    with pytest.raises(ValueError):
        t.upsert(frame(spark, [(1, "x", 1), (1, "y", 2)]), ["k"])
    with pytest.raises(ValueError):
        t.append(frame(spark, [(7, "x", 1)]))
    assert t.append(frame(spark, [(7, "x", 12)])) == 2
    before = folders(tmp_path)
    assert t.keep_days(3) == 3 and rows_of(t.read()) == [(2, "B", 9), (3, "c", 9), (4, "d", 9), (7, "x", 12)]
    assert folders(tmp_path) == before


def test_a_crash_before_publication_leaves_the_old_table(spark, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.replace(frame(spark, [(1, "a", 1)]))

    def die(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(type(t.log), "publish", die)
        with pytest.raises(RuntimeError):
            t.replace(frame(spark, [(9, "z", 1)]))
    assert rows_of(table(spark, tmp_path).read()) == [(1, "a", 1)] and t.log.latest() == 0
    assert t.replace(t.read().withColumn("v", F.lit("again"))) == 1 and rows_of(t.read()) == [(1, "again", 1)]


def test_two_writers(spark, tmp_path):
    t, other = table(spark, tmp_path), table(spark, tmp_path)
    t.replace(frame(spark, [(1, "a", 1)]))
    new = t._write(frame(spark, [(2, "b", 2)]))
    other.replace(frame(spark, [(3, "c", 3)]))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        t._publish(new, 0)
    assert rows_of(t.read()) == [(3, "c", 3)]


def test_empty_table(spark, tmp_path):
    t = table(spark, tmp_path)
    assert t.replace(frame(spark, [])) == 0 and t.log.latest() == 0 and t.read().count() == 0
    assert t.upsert(frame(spark, [(1, "a:b=c", 1)]), ["k"]) == 1 and rows_of(t.read()) == [(1, "a:b=c", 1)]


def test_names_of_partitions(spark, tmp_path):
    t = VersionedTable(spark, f"{tmp_path}/n", "k long, kind string", "kind")
    rows = [(i, v) for i, v in enumerate(["a/b", "x=y", "50%", "plain", "q?*:'\"", "č ž", "{[}]^#"])]
    t.replace(spark.createDataFrame(rows, "k long, kind string"))
    assert sorted(map(tuple, t.read().collect())) == rows
    assert [tuple(r) for r in t.read(only=["50%"]).collect()] == [(2, "50%")]
