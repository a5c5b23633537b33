import datetime as dt
import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrift.operators import assemble, behaviour, dictionary, incremental, interests, lift, models, rank, scores, stats, targets
from spindrift.operators import sessions as S
from spindrift.plans import queries as plans
from spindrift.sources import io
from spindrift.streaming import sessions as streaming

SF = "/root/testdata/sf0.001"


def hits(spark, rows):
    """(device, seconds) rows as hits."""
    data = [(i, d, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)) for i, (d, s) in enumerate(rows)]
    return spark.createDataFrame(data, "event_id long, device string, ts timestamp").withColumn("referrer_host", F.col("event_id").cast("string"))


GAPS = [("u1", 0), ("u1", 1800), ("u1", 3601), ("u2", 0), ("u2", 1799), ("u3", 5), ("u3", 5), ("u4", 0)]


def test_gaps(spark):
    got = S.order_into_sessions(hits(spark, GAPS)).orderBy("event_id").select("ordinal", "minutes", "referrer_first").collect()
    assert [r[0] for r in got] == [0, 1, 2, 0, 0, 0, 0, 0]
    assert [r[1] for r in got] == [0, 0, 0, 0, pytest.approx(1799 / 60), 0, 0, 0]
    assert [r[2] for r in got][3:7] == ["3", "3", "5", "5"]


def test_stream_equals_batch(spark, tmp_path):
    hits(spark, GAPS).select("device", "ts").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("device string, ts timestamp").parquet(f"{tmp_path}/in")
    closed = streaming.stream_sessions(hits(spark, GAPS)).select("device", "n_events").collect()
    assert sorted(map(tuple, closed)) == [("u1", 1), ("u1", 1), ("u1", 1), ("u2", 2), ("u3", 2), ("u4", 1)]
    q = streaming.stream_sessions(stream).writeStream.outputMode("complete").format("memory").queryName("closed").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/c").start()
    q.awaitTermination()
    assert sorted(map(tuple, spark.table("closed").select("device", "n_events").collect())) == sorted(map(tuple, closed))


def test_last_used(spark):
    df = spark.createDataFrame([("u1", 10, "a"), ("u1", 20, "b"), ("u1", 20, "c"), ("u1", 5, "z"), ("u2", 5, "q"), ("u2", 9, None)], "u string, t int, v string")
    got = dict(df.groupBy("u").agg(behaviour.last_used("v", "t")).collect())
    assert got == {"u1": "c", "u2": None}


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_ranks_equal_windows(spark, parts):
    rng = random.Random(parts)
    data = [(i, rng.choice([None, *[x / 7 for x in range(20)]]), rng.random(), rng.choice(["a", "b"])) for i in range(500)]
    df = spark.createDataFrame(data, "id long, s double, r double, g string").repartition(parts)
    got = rank.percent_ranks(df, ["s", "r"]).withColumns({"ws": F.percent_rank().over(Window.orderBy("s")), "wr": F.percent_rank().over(Window.orderBy("r"))})
    assert got.where("abs(s_rank - ws) > 1e-12 or abs(r_rank - wr) > 1e-12").count() == 0 and got.count() == 500
    keyed = rank.percent_ranks(df.drop("g"), ["s", "r"], key="id").join(got.select("id", "ws", "wr"), "id")
    assert keyed.where("abs(s_rank - ws) > 1e-12 or abs(r_rank - wr) > 1e-12 or s_rank is null or r_rank is null").count() == 0 and keyed.count() == 500
    by = rank.percent_ranks(df, ["s"], by="g").withColumn("w", F.percent_rank().over(Window.partitionBy("g").orderBy("s")))
    assert by.where("abs(s_rank - w) > 1e-12").count() == 0 and by.count() == 500
    for k in (1, 3, 7, 600):
        t = rank.ntiles(df.where("s is not null"), "s", "id", k).withColumn("w", F.ntile(k).over(Window.orderBy(F.desc("s"), "id")))
        assert t.where("bucket <> w").count() == 0


def test_rank_edges(spark):
    schema = "id long, s double"
    assert [r.s_rank for r in rank.percent_ranks(spark.createDataFrame([(1, 5.0)], schema), ["s"]).collect()] == [0.0]
    assert {r.s_rank for r in rank.percent_ranks(spark.createDataFrame([(1, None), (2, None)], schema), ["s"]).collect()} == {0.0}
    assert {r.s_rank for r in rank.percent_ranks(spark.createDataFrame([(1, 2.0), (2, 2.0), (3, 2.0)], schema), ["s"]).collect()} == {0.0}
    assert rank.percent_ranks(spark.createDataFrame([], schema), ["s"]).count() == 0


def test_box_cox_is_a_maximum(spark):
    rng = random.Random(3)
    xs = [math.exp(rng.gauss(0, 0.7)) for _ in range(400)]
    df = spark.createDataFrame([(x, 4.0, None if i % 9 == 0 else x) for i, x in enumerate(xs)], "x double, c double, n double")
    found = stats.box_cox_lambdas(df, ["x", "c", "n"])
    shift, lam = found["x"]

    def llf(v):
        t = [x + shift for x in xs]
        y = [math.log(a) if abs(v) < 1e-12 else (a**v - 1) / v for a in t]
        m = sum(y) / len(y)
        return (v - 1) * sum(map(math.log, t)) - len(t) / 2 * math.log(sum((a - m) ** 2 for a in y) / len(y))

    assert all(llf(lam) >= llf(lam + d) for d in (-0.01, 0.01, -0.2, 0.2)) and found["c"][1] == 1.0
    out = stats.standardise(stats.box_cox_transform(df.select("x", "c"), ["x", "c"]), ["x", "c"])
    row = out.agg(F.avg("x"), F.stddev_samp("x"), F.max(F.abs("c"))).first()
    assert row[0] == pytest.approx(0, abs=1e-9) and row[1] == pytest.approx(1) and row[2] == 0


def test_increments(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    once = incremental.upsert(base, new, "k")
    assert sorted(map(tuple, once.collect())) == [(1, "a"), (2, "c"), (3, "d")]
    assert sorted(map(tuple, incremental.upsert(once, new, "k").collect())) == sorted(map(tuple, once.collect()))
    with pytest.raises(ValueError):
        incremental.upsert(base, new.unionByName(new), "k")
    assert incremental.has_duplicates(new.unionByName(new), "k") and not incremental.has_duplicates(new, "k")
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 32)], "d date")
    assert incremental.keep_days(days, "d", 7).count() == 8 and incremental.keep_days(days, "d", 7, least=60).count() == 31
    assert incremental.lookback(days, "d", "2024-01-31", 7).count() == 7
    mark = spark.createDataFrame([(None,)], "mark timestamp")
    rows = days.withColumn("ts", F.col("d").cast("timestamp"))
    assert incremental.since(rows, "d", "ts", mark, as_of="2024-01-31").count() == 8
    assert incremental.high_water(rows, "d", "ts", 5, "2024-01-20") == dt.datetime(2024, 1, 20)


def test_guard_and_files(spark, tmp_path):
    want = T.StructType([T.StructField("a", T.IntegerType(), False), T.StructField("b", T.StringType()), T.StructField("c", T.DateType())])
    have = T.StructType([T.StructField("a", T.IntegerType(), True), T.StructField("b", T.LongType()), T.StructField("x", T.DateType())])
    assert len(io.violations(have, want)) == 4 and io.violations(want, want) == []
    df = spark.createDataFrame([(1, "x", dt.date(2024, 1, 1))], want)
    path = f"{tmp_path}/t"
    assert not io.exists(spark, path)
    io.create_if_missing(spark, path, want)
    io.create_if_missing(spark, path, want)
    assert io.exists(spark, path)
    io.write(df, f"{tmp_path}/p", want, "overwrite", ["c"])
    io.write(df.withColumn("c", F.lit("2024-01-02").cast("date")), f"{tmp_path}/p", want, "overwrite", ["c"])
    assert spark.read.parquet(f"{tmp_path}/p").count() == 2
    with pytest.raises(ValueError):
        io.write(df.drop("b"), path, want)
    with pytest.raises(ValueError):
        io.read_stage(spark, path, "not a day")


def test_events_from_json(spark, tmp_path):
    folder = tmp_path / "raw" / "day=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "shop_01.json").write_text('{"events": [{"url": "u1", "p": {"x": 1}}, {"url": "u2", "p": null}]}')
    (folder / "other.json").write_text('{"events": []}')
    rows = io.read_events(spark, f"{tmp_path}/raw", "events array<struct<url:string,p:struct<x:long>>>, day date", F.col("day") >= F.lit("2024-01-01").cast("date"))
    flat = io.flatten(rows.select("owner_name", "event")).collect()
    assert sorted(map(tuple, flat)) == [("shop", "u1", 1), ("shop", "u2", None)]
    with pytest.raises(ValueError):
        io.flat_columns(T.StructType.fromDDL("a struct<x:int>, b struct<x:int>"))
    first = io.first_entries(spark.createDataFrame([([("g", "i")], ["s"])], "p array<struct<group:string,item:string>>, q array<string>"), ["p", "q"]).first()
    assert first.p.item == "i" and first.q is None


def test_targets_and_scores(spark):
    rows = spark.createDataFrame([("u1", "20", "1"), ("u1", "unknown", "2"), ("u2", "70", "1"), ("u2", "71", "1")], "user_id string, age string, gender string")
    got = {r.user_id: (r.target_age, r.target_gender) for r in targets.resolved(rows).collect()}
    assert got == {"u1": ("1", "unknown"), "u2": ("6", "0")}
    b = {f"{i}_{e}": 0.0 for i in scores.INCOME for e in scores.EDUCATION} | {"high_vs": 2.0, "low_zs": 1.0}
    df = spark.createDataFrame([("u", *b.values())], "user_id string, " + ", ".join(f"{k} double" for k in b))
    from spindrift.functions import scalars

    row = df.select(*[v.alias(k) for k, v in scalars.brackets({k: F.col(k) for k in b}).items()]).first()
    assert (row.A, row.B, row.E) == (2.0, 0.0, 1.0)


def test_lift_and_assembly(spark):
    df = spark.createDataFrame([(i, 1 - i / 20, int(i < 5)) for i in range(20)], "id long, s double, t int")
    got = lift.curve(df, "s", "t", "id", 4).orderBy("bucket").collect()
    assert [r.hits for r in got] == [5, 0, 0, 0] and got[0].cum_lift == 4.0 and got[-1].cum_lift == 1.0
    a = spark.createDataFrame([("u1", 1, 5)], "user_id string, timestamp int, n_x int")
    b = spark.createDataFrame([("u2", 1, 7)], "user_id string, timestamp int, n_y int")
    out = assemble.assemble([a, b], {"n_{what}": 0}).orderBy("user_id").collect()
    assert [tuple(r) for r in out] == [("u1", 1, 5, 0), ("u2", 1, 0, 7)]
    seen, watch = assemble.counted(a, "a", big=F.col("n_x") > 1)
    seen.collect()
    assert watch.get == {"rows": 1, "big": 1}


@pytest.mark.parametrize("name", ["url_normalize", "url_adform", "device_parse", "sessionize", "session_rollup", "tokens_clean", "stem_cs", "interest_affinity"])
def test_plans_stay_in_the_jvm(spark, name):
    plan = plans.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInArrow"))


def test_logistic_probability_as_an_expression(spark):
    """Equal to the fitted model's, and computed in a session that observes metrics."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import Observation

    rows = spark.range(200).select("id", F.array((F.col("id") % 7).cast("double"), (F.col("id") % 11).cast("double")).alias("x"), (F.col("id") % 7 + F.col("id") % 3 > 4).cast("double").alias("label"))
    rows = rows.withColumn("features", array_to_vector("x"))
    model = LogisticRegression(maxIter=10).fit(rows)
    rows.observe(Observation(), F.count(F.lit(1)).alias("n")).collect()
    for r in models.probability(rows, model, "p").collect():
        z = float(model.intercept + sum(a * b for a, b in zip(r.x, model.coefficients.toArray(), strict=True)))
        assert abs(r.p - 1 / (1 + 2.718281828459045 ** -z)) < 1e-9
    scored = models.score_all(rows.withColumnRenamed("id", "user_id"), {"m": model, "none": None}).collect()
    assert len(scored) == 200 and max(r.m_percentile for r in scored) <= 1 and {r.none_probability for r in scored} == {-1.0}


def test_language_words(spark):
    from spindrift.functions import text

    assert {"und", "nicht"} <= set(text.language_words("german")) and "the" in text.language_words("english")
    got = spark.createDataFrame([("Der Hund und die Katze",)], "t string").select(text.clean_tokens("t", text.language_words("german"))).first()[0]
    assert got == ["hund", "katze"]


def test_landed_days(spark):
    day = lambda n: dt.date(2024, 1, n)
    df = spark.createDataFrame([(day(n),) for n in range(1, 11)], "day date")
    read = lambda *a, **k: sorted(r.day.day for r in df.where(io.landed_days(io.newest_day(df), *a, **k)).collect())
    assert read("long", days=2) == [7, 8, 9, 10]
    assert read("long", reached=day(9), days=2) == [9, 10]
    assert read("short", hours=24) == [9, 10] and read("short", hours=25) == [8, 9, 10]
    with pytest.raises(ValueError):
        io.landed_days(day(1), "medium")


def test_dictionary_tokens(spark):
    df = spark.createDataFrame([("u1", "Red foxes jump", None), ("u2", None, "blue"), ("u3", "", "red red")], "url_normalized string, a string, b string")
    d = dictionary.pooled_tokens(dictionary.field_tokens(df, ["b", "a"]), ["b", "a"])
    got = {r.url_normalized: r for r in d.collect()}
    assert got["u1"].tokens_all_cleaned == ["red", "foxes", "jump"] and got["u1"].tokens_all_cleaned_bigrams == ["red foxes", "foxes jump"]
    assert got["u2"].tokens_all_cleaned == ["blue"] and got["u2"].tokens_all_cleaned_bigrams == []
    assert got["u3"].tokens_all_cleaned == ["red", "red"] and got["u3"].tokens_all_cleaned_unique == ["red"]
    with pytest.warns(UserWarning):
        assert dictionary.chosen(d, "other").where("url_normalized = 'u1'").first().tokens == ["red", "foxes", "jump"]
    views = spark.createDataFrame([(1, "u2"), (2, "u9"), (3, None)], "v int, url_normalized string")
    met = {r.v: r.tokens for r in dictionary.with_tokens(views, dictionary.chosen(d, bigrams=True)).collect()}
    assert met == {1: ["blue"], 2: None, 3: None}


def test_paired_dictionary(spark):
    rows = [("s1", "g", ["Sea side"], ["sea side"]), ("s2", "g", ["hill"], None), ("s3", None, ["x1"], ["x1 x2"])]
    d = interests.paired_dictionary(spark.createDataFrame(rows, "subinterest string, general_interest string, keywords array<string>, keywords_bigrams array<string>"))
    assert sorted(map(tuple, d.collect())) == [("s1", "g", "sea"), ("s1", "g", "sea side"), ("s1", "g", "side")]


def test_bigrams_of_texts_without_spaces(spark, tmp_path):
    """Texts of one word have no bigram, and words may be parted by other signs: queries and SQL agree."""
    from spindrift.plans import queries as plans
    from tests.compare import TABLES, rows, sql_rows

    texts = ["eaux", "red\nfoxes", "the sea", "one-two three", "", None, "the"]
    frames = {
        "documents": ([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), "labels": ([(i, i % 2) for i in range(len(texts))], "doc_id long, quality int"),
        "conversations": ([(i, i % 5, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string"),
    }
    for t in TABLES:
        data, schema = frames.get(t, ([(1,)], "x int"))
        spark.createDataFrame(data, schema).toPandas().to_parquet(f"{tmp_path}/{t}.parquet")
    for name in ("interest_bigrams", "interest_pairs"):
        assert rows(plans.QUERIES[name](spark, str(tmp_path)).toPandas()) == rows(sql_rows(plans.ORACLE_SQL[name], str(tmp_path))), name


def test_columns_and_models_that_fail(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0)], "user_id long, x_y double")
    assert assemble.columns_like(df, "x_") == ["x_y"] and assemble.columns_like(df, "y") == []
    with pytest.warns(UserWarning):
        failed = models.load({"m": f"{tmp_path}/none"}, optional=True)
    row = models.score_all(df, failed, complement={"w": "m"}, missing=None).first().asDict()
    assert row == {"user_id": 1, "m_probability": None, "m_percentile": None, "w_probability": None, "w_percentile": None}
