"""Ranks that carry their key and Box-Cox from a histogram, against windows and numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from spindrift.operators import rank, stats


@pytest.mark.parametrize("parts", [1, 4, 17])
@pytest.mark.parametrize("hot", [0.0, 0.6, 1.0])
def test_one_score_shared_by_many(spark, parts, hot):
    rng = random.Random(parts)
    pick = lambda: 0.5 if rng.random() < hot else rng.choice([None, float("nan"), rng.random(), 0.25])
    df = spark.createDataFrame([(i, pick(), rng.choice(["a", "b", None])) for i in range(700)], "id long, s double, g string").repartition(3)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        over = rank.percent_ranks(df, ["s"], key="id").withColumn("w", F.percent_rank().over(Window.orderBy("s"))).collect()
        by = rank.percent_ranks(df, ["s"], by="g", key="id").withColumn("w", F.percent_rank().over(Window.partitionBy("g").orderBy("s"))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    for found in (over, by):
        assert len(found) == 700 and all(r.s_rank == pytest.approx(r.w, abs=1e-12) for r in found)


def test_no_join_on_a_score(spark):
    df = spark.createDataFrame([(i, float(i % 3), float(i % 5)) for i in range(50)], "id long, s double, r double")
    plan = rank.percent_ranks(df, ["s", "r"], key="id")._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert joins and not any(f"{c}#" in line for line in joins for c in ("s", "r"))


def test_names_of_callers_stay(spark):
    df = spark.createDataFrame([(i, float(i % 7), 1, 2, 3, 4) for i in range(30)], "id long, s double, before int, _part int, _number int, k int")
    got = rank.ntiles(df, "s", "id", 4)
    assert got.columns == [*df.columns, "bucket"] and {tuple(r)[2:6] for r in got.collect()} == {(1, 2, 3, 4)}
    got = rank.percent_ranks(df, ["s"])
    assert got.columns == [*df.columns, "s_rank"] and {tuple(r)[2:6] for r in got.collect()} == {(1, 2, 3, 4)}


def likelihood(t, lam):
    y = np.log(t) if abs(lam) < 1e-12 else np.expm1(lam * np.log(t)) / lam
    return (lam - 1) * np.log(t).sum() - len(t) / 2 * math.log(y.var())


def best(t):
    a, z = max(((x - 0.01, x + 0.01) for x in np.linspace(-5, 5, 1001)), key=lambda r: likelihood(t, sum(r) / 2))
    while z - a > 1e-9:
        x, y = a + (z - a) / 3, z - (z - a) / 3
        a, z = (a, y) if likelihood(t, x) >= likelihood(t, y) else (x, z)
    return (a + z) / 2


SAMPLES = {
    "normal": lambda g: g.normal(0, 1, 3000), "wide": lambda g: np.exp(g.normal(0, 1.5, 3000)), "counts": lambda g: g.integers(0, 101, 3000).astype(float), "few": lambda g: np.asarray([1.0, 2, 5, 9]), "heavy": lambda g: g.pareto(1.5, 3000),
}


def test_lambdas(spark):
    columns = {k: f(np.random.default_rng(5)) for k, f in SAMPLES.items()}
    n = max(map(len, columns.values()))
    rows = [tuple(float(v[i]) if i < len(v) else None for v in columns.values()) + (4.0, None) for i in range(n)]
    df = spark.createDataFrame(rows, ", ".join(f"{k} double" for k in [*columns, "same", "none"]))
    found = stats.box_cox_lambdas(df, df.columns)
    for k, v in columns.items():
        shift, lam = found[k]
        assert shift == pytest.approx(abs(v.min()) + 0.01) and abs(lam - best(v + shift)) < 1e-6, k
    assert found["same"] == (4.01, 1.0) and "none" not in found
    assert stats.box_cox_lambdas(df, ["normal"], digits=2)["normal"][1] == round(found["normal"][1], 2)
    assert stats.box_cox_lambdas(df.where("false"), ["normal"]) == {}
    huge = spark.createDataFrame([(1e300,), (1.0,), (1e-300,)], "x double")
    assert -5 <= stats.box_cox_lambdas(huge, ["x"])["x"][1] <= 5


def test_the_table_is_scanned_twice(spark):
    seen = []
    df = spark.range(500).select((F.col("id") % 83).cast("double").alias("x"))
    collect, first = type(df).collect, type(df).first
    try:
        type(df).collect = lambda self: seen.append(1) or collect(self)
        type(df).first = lambda self: seen.append(1) or first(self)
        stats.box_cox_lambdas(df, ["x"])
    finally:
        type(df).collect, type(df).first = collect, first
    assert len(seen) <= 3  # first() may go through collect()


@pytest.mark.parametrize("k", [2, 7, 10])
def test_percentiles_of_more_values_than_a_sketch_holds(spark, k):
    values = sorted(random.Random(k).choices(range(10**6), k=30_011))
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x int").repartition(5)
    found = stats.column_stats(df, "x", k).first()
    assert found.percentiles == [values[-(-i * len(values) // k) - 1] for i in range(1, k)]
    assert found.mean == pytest.approx(sum(values) / len(values))
    assert tuple(stats.column_stats(df.where("x IS NULL"), "x", k).first()) == (None, None)
