"""Landed files with faults, narrow types, files loaded before; and sketches against exact ranks."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from spindrift.operators import stats
from spindrift.sources import landing

FIELDS = {"id": "bigint", "url": "string", "seconds": "smallint", "share": "double", "at": "timestamp", "params": "entry", "ok": "boolean"}


def drop(folder, name, events, text=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text if text is not None else "\n".join(json.dumps({"events": [e]}) for e in events) + "\n\n")


def test_faulty_files_are_listed_and_left_out(spark, tmp_path):
    event = {"id": 1, "url": "u", "seconds": 5, "share": 1, "at": "2024-01-02 03:04:05", "params": [{"group": "g", "item": "i"}, {"group": "h", "item": "j"}], "ok": True}
    a, b = tmp_path / "day=2024-01-01", tmp_path / "day=2024-01-02"
    drop(a, "shop_01.json", [event, event | {"id": 2, "seconds": 70_000, "share": 0.25, "at": "no time", "params": ["plain"], "extra": 1}])
    drop(a, "shop_02.json", [], '{"events": [{"id": 3, "url": null, "params": []}, {"id": 4}]}\n{"events": []}')
    drop(b, "news_01.json", [event | {"id": "five"}])
    drop(b, "news_02.json", [event], '{"events": [{"id": 6')
    drop(b, "news_03.json", [{"url": "u", "params": [{"group": 1, "item": {"x": 2}}], "ok": "yes"}])
    drop(b, "odd.json", [], '{"other": 1}')
    drop(b, "shop_03.json", [event | {"id": 7}])
    rows, faults = landing.load(spark, str(tmp_path), FIELDS, required=["id"])
    got = {r.id: r for r in rows.collect()}
    assert set(got) == {1, 2, 3, 4, 7} and rows.where("owner_name <> 'shop'").count() == 0
    assert (got[1].seconds, got[1].share, got[1].at, got[1].params.item, got[1].ok) == (5, 1.0, dt.datetime(2024, 1, 2, 3, 4, 5), "i", True)
    assert (got[2].seconds, got[2].share, got[2].at, got[2].params) == (None, 0.25, None, None) and got[3].url is None and got[3].params is None
    assert dict(rows.dtypes)["seconds"] == "smallint" and "extra" not in rows.columns
    why = {r.source_file.rpartition("/")[2]: r.reasons for r in faults.collect()}
    assert why == {
        "news_01.json": ["type of id: STRING, not bigint"], "news_02.json": ["not JSON"], "news_03.json": ["missing: id", "type of ok: STRING, not boolean"], "odd.json": ["no list of events"],
    }
    loaded = rows.select("source_file").distinct()
    assert landing.load(spark, str(tmp_path), FIELDS, ["id"], known=loaded)[0].count() == 0
    again, _ = landing.load(spark, str(tmp_path), FIELDS, ["id"], known=loaded.where("source_file like '%shop_03%'"))
    assert {r.id for r in again.collect()} == {1, 2, 3, 4}
    with pytest.raises(ValueError):
        landing.load(spark, str(tmp_path), {"id": "map"})


def test_a_file_of_one_document(spark, tmp_path):
    drop(tmp_path, "shop_01.json", [], json.dumps({"events": [{"id": 1}, {"id": 2}]}, indent=2))
    rows, faults = landing.load(spark, str(tmp_path), {"id": "int"}, whole=True)
    assert sorted(r.id for r in rows.collect()) == [1, 2] and faults.count() == 0


def test_merged_sketches(spark):
    rng = random.Random(4)
    data = [(i % 30, rng.gauss(0, 1) * (1 + i % 30)) for i in range(30_000)] + [(99, None)]
    df = spark.createDataFrame(data, "day int, x double")
    daily = stats.quantile_sketches(df, ["day"], "x", k=400)
    assert daily.count() == 30
    shares = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
    found = stats.sketch_quantiles(stats.merged_sketches(daily), shares).first()
    xs = sorted(x for _, x in data if x is not None)
    assert found.n == len(xs)
    for share, q in zip(shares, found.quantiles, strict=True):
        assert abs(sum(x <= q for x in xs) / len(xs) - share) <= 3 * stats.rank_error(400)
    weekly = stats.merged_sketches(daily.withColumn("week", F.expr("day div 7")), ["week"])
    assert {r.week: r.n for r in weekly.collect()} == {0: 7000, 1: 7000, 2: 7000, 3: 7000, 4: 2000}
    assert stats.rank_error(200) == pytest.approx(0.0133, abs=1e-4)
    assert stats.quantile_sketches(df.where("false"), ["day"], "x").count() == 0
