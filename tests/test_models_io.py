"""Saved models with their preparation, word vectors and database ranges."""

import random
import uuid

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.sql import functions as F

from spindrift.operators import models, synonyms
from spindrift.sources import io

FIELDS = {"numbers": ["n"], "flags": ["x_flag"], "categories": ["kind", "kind_place"]}


def rows(spark, n=400, seed=2):
    rng = random.Random(seed)
    data = [(i, rng.random(), rng.randint(0, 1), rng.choice("abc"), rng.choice(["p", "q"]), None) for i in range(n)]
    return spark.createDataFrame([(*r[:5], float(r[3] == "a" and r[1] > 0.3)) for r in data], "user_id long, n double, x_flag int, kind string, kind_place string, label double")


@pytest.mark.parametrize("estimator", [lambda: GBTClassifier(maxIter=4, maxDepth=3, seed=1), lambda: LogisticRegression(maxIter=30)])
def test_a_saved_model_scores_as_the_fitted_one(spark, tmp_path, estimator):
    df = rows(spark)
    model = models.pipeline(FIELDS, estimator()).fit(df)
    models.save(model, f"{tmp_path}/m")
    new = df.unionByName(df.limit(1).withColumns({"user_id": F.lit(9999).cast("long"), "kind": F.lit("unseen")}))
    score = lambda m: {r.user_id: (r.m_probability, r.m_percentile) for r in models.score_all(new, {"m": m}).collect()}
    loaded = models.load({"m": f"{tmp_path}/m"})["m"]
    assert score(model) == score(loaded) and len(score(loaded)) == 401
    right = models.probability(df, loaded, "p").select(((F.col("p") > 0.5).cast("double") == F.col("label")).cast("int").alias("r")).agg(F.avg("r")).first()[0]
    assert right > 0.85
    found = models.column_importances(spark, loaded, df).collect()
    by = {}
    for r in found:
        by[r["column"]] = by.get(r["column"], 0) + abs(r.importance)
    assert set(by) == {"n", "x_flag", "kind", "kind_place"} and {k for k, _ in sorted(by.items(), key=lambda x: -x[1])[:2]} == {"n", "kind"}


def test_only_a_missing_path_is_optional(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert models.load({"m": f"{tmp_path}/none"}, optional=True) == {"m": None}
    with pytest.raises(Exception, match="none"):
        models.load({"m": f"{tmp_path}/none"})
    (tmp_path / "broken" / "metadata").mkdir(parents=True)
    (tmp_path / "broken" / "metadata" / "part-00000").write_text("no model")
    with pytest.raises(Exception):  # noqa: B017
        models.load({"m": f"{tmp_path}/broken"}, optional=True)


def test_planted_synonyms(spark, tmp_path):
    """Words that are used alike are near each other; two runs agree."""
    rng = random.Random(6)
    topics = {"sea": ["ship", "boat"], "sky": ["plane", "jet"], "road": ["car", "truck"]}
    text = []
    for _ in range(1500):
        t = rng.choice(list(topics))
        around = [f"{t}{rng.randrange(6)}" for _ in range(6)]
        around.insert(3, rng.choice(topics[t]))
        text.append((around,))
    df = spark.createDataFrame(text, "tokens array<string>").repartition(5)
    model = synonyms.fit(df, "tokens", size=16, least=5, steps=6)
    synonyms.save(model, f"{tmp_path}/w")
    for a, b in topics.values():
        near = synonyms.synonyms(synonyms.load(f"{tmp_path}/w"), [a], 3).collect()
        assert len(near) == 3 and b in [r.word for r in synonyms.synonyms(model, [a], 3).collect()]
    again = synonyms.fit(df.repartition(2), "tokens", size=16, least=5, steps=6)
    table = lambda m: {r.word: r.vector for r in synonyms.vectors(m).collect()}
    assert table(model) == table(again) == table(synonyms.load(f"{tmp_path}/w"))


def test_words_are_shared_among_tasks(spark, monkeypatch):
    """A long table trains in several tasks, and words that are used alike are still near each other."""
    rng = random.Random(8)
    topics = {"sea": ["ship", "boat"], "sky": ["plane", "jet"], "road": ["car", "truck"]}
    rows = [([*(f"{t}{rng.randrange(6)}" for _ in range(3)), rng.choice(topics[t]), *(f"{t}{rng.randrange(6)}" for _ in range(3))],) for t in rng.choices(list(topics), k=6000)]
    df = spark.createDataFrame(rows, "tokens array<string>").repartition(5)
    assert synonyms.shares(df, "tokens") == 1 and synonyms.shares(df, "tokens", 10_000) == 5 and synonyms.shares(df.where("false"), "tokens") == 1
    asked = []
    Word2Vec = synonyms.Word2Vec
    monkeypatch.setattr(synonyms, "Word2Vec", lambda **kw: asked.append(kw["numPartitions"]) or Word2Vec(**kw))
    monkeypatch.setattr(synonyms.shares, "__defaults__", (10_000,))
    model = synonyms.fit(df, "tokens", size=16, least=5, steps=6)
    assert asked == [5]
    for a, b in topics.values():
        assert b in [r.word for r in synonyms.synonyms(model, [a], 3).collect()]


def test_vectors_stay_in_tables(spark, tmp_path):
    """What is fitted and loaded is read by tasks: the driver holds neither words nor vectors."""
    df = spark.createDataFrame([([f"w{i % 50}", f"w{i % 7}", f"w{i % 3}"],) for i in range(500)], "tokens array<string>")
    model = synonyms.fit(df, "tokens", size=4, least=2, parts=2)
    synonyms.save(model, f"{tmp_path}/w")
    for m in (model, synonyms.load(f"{tmp_path}/w")):
        near = synonyms.synonyms(m, ["w1"], 3)
        plan = near._jdf.queryExecution().optimizedPlan().toString()
        assert "LocalRelation" not in plan and "parquet" in plan and near.count() == 3
        assert {r.word for r in synonyms.vectors(m).collect()} == {f"w{i}" for i in range(50)}
    assert synonyms.fit(df, "tokens", size=4, least=10_000).count() == 0


def test_copies_are_dealt_among_shares(spark):
    """Copies of a text spread over shares, whatever the partitions; texts of one word are left out; words are counted over all shares."""
    data = [(["a", "b", "c"],)] * 1000 + [(["x"],)] * 9 + [(["d", f"e{i}"],) for i in range(40)] + [(None,), ([],)]
    df = spark.createDataFrame(data, "tokens array<string>")
    rows = [sorted(map(tuple, synonyms.dealt(df.repartition(n), "tokens", 4).collect())) for n in (2, 5)]
    texts = [t.split(synonyms.GAP) for _, t in rows[0]]
    assert rows[0] == rows[1] and sorted(texts) == sorted(t for t, in data if t and len(t) > 1)
    assert all(200 < sum(s == share and t[0] == "a" for s, t in rows[0]) < 300 for share in range(4))
    known = synonyms.vocabulary(synonyms.dealt(df, "tokens", 4), 40).collect()
    assert {r.word for r in known} == {"a", "b", "c", "d"} and len(set(known)) == len(known) >= 4 * 3


def test_training_against_single_pairs(monkeypatch):
    """Blocks, stretches and their overlaps give what adding up pair by pair gives."""
    monkeypatch.setattr(synonyms, "BLOCK", 128)
    rng = np.random.default_rng(4)
    n, window, size = 64 * 64 * 2 + 37, 3, 4
    ids, doc = rng.integers(0, 30, n).astype(np.int32), np.sort(rng.integers(0, n // 5, n)).astype(np.int32)
    u, v = (rng.normal(0, 0.3, (30, size)).astype(np.float32) for _ in range(2))
    a, b = u.astype(float), v.astype(float)
    synonyms.train(ids, doc, u, v, window, np.random.default_rng(9))
    draw = np.random.default_rng(9)
    reach, odds = draw.integers(1, window + 1, n + -n % 64, dtype=np.int16).tolist(), np.cumsum(np.bincount(ids) ** 0.75)
    squares = np.zeros(30), np.zeros(30)
    miss = lambda x: 1 / (1 + np.exp(x))
    for k in range(0, n, 128):
        da, db = np.zeros_like(a), np.zeros_like(b)
        others = np.searchsorted(odds, draw.random(synonyms.DRAWN) * odds[-1], side="right")
        for i in range(k, min(n, k + 128)):
            near = [j for j in range(max(0, i - reach[i]), min(n, i + reach[i] + 1)) if j != i and doc[j] == doc[i]]
            for j in near:
                da[ids[i]] += (g := miss(a[ids[i]] @ b[ids[j]])) * b[ids[j]]
                db[ids[j]] += g * a[ids[i]]
            g = miss(-(b[others] @ a[ids[i]])) * len(near) * synonyms.NEGATIVES / synonyms.DRAWN
            da[ids[i]] -= g @ b[others]
            np.add.at(db, others, -g[:, None] * a[ids[i]])
        for table, square, d in ((a, squares[0], da), (b, squares[1], db)):
            square += (d * d).mean(1)
            table += synonyms.RATE * d / np.sqrt(square + 1e-10)[:, None]
    assert np.abs(u - a).max() < 1e-3 and np.abs(v - b).max() < 1e-3 and len(set(reach[:50])) == 3


def test_database_in_ranges(spark):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    rng = random.Random(3)
    data = [(i, rng.choice([1, 2, 3, 1000 * i, None]), f"it's {i}") for i in range(300)]
    df = spark.createDataFrame(data, "id long, key long, name string").coalesce(2)
    io.write_jdbc(df, url, "T")
    io.write_jdbc(df.limit(5), url, "T")
    assert io.read_jdbc(spark, url, "T").count() == 305
    io.write_jdbc(df, url, "T", mode="overwrite")
    for column, parts in (('"id"', 7), ('"key"', 6), ('"id"', 1)):
        got = io.read_jdbc(spark, url, "T", column, parts=parts)
        assert sorted(map(tuple, got.collect())) == sorted(data) and got.rdd.getNumPartitions() <= parts
    sizes = [r[0] for r in io.read_jdbc(spark, url, "T", '"id"', parts=7).groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    spark.createDataFrame([], "id long").write.jdbc(url, "E")
    assert io.read_jdbc(spark, url, "E", '"id"').count() == 0
