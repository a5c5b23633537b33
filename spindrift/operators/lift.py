"""Lift of scores and tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.operators import rank


def curve(predictions: DataFrame, score: str, target: str, tie: str, buckets: int = 10, positive: object = 1) -> DataFrame:
    """bucket, n, hits, avg_score, cum_avg_hits, cum_lift: buckets of equal size by falling score. The lift compares a
    bucket and those before it with all. The windows run over the buckets' rows only."""
    hit = (F.col(target) == positive).cast("long")
    rows = rank.ntiles(predictions.select(score, tie, hit.alias("hit")), score, tie, buckets)
    per = rows.groupBy("bucket").agg(F.count("hit").alias("n"), F.sum("hit").alias("hits"), F.avg(score).alias("avg_score"))
    running = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("cum_avg_hits", F.avg("hits").over(running))
    return per.withColumn("cum_lift", F.try_divide("cum_avg_hits", F.last("cum_avg_hits").over(whole)))


def train_test(train: DataFrame, test: DataFrame, score: str, target: str, tie: str, buckets: int = 10, positive: object = 1) -> DataFrame:
    a, b = (curve(x, score, target, tie, buckets, positive).select("bucket", F.col("cum_lift").alias(f"cum_lift_{n}")) for x, n in ((train, "train"), (test, "test")))
    return a.join(b, "bucket")


def token_significance(rows: DataFrame, user: str, power: float = 1.0, least_users: int = 30) -> DataFrame:
    """hits, users, foreground, background (percent of users), lift, diff and jlh of each token of ``tokens``; ``target``
    marks the foreground. One grouping gives both sides; users are counted once a token."""
    hit = F.col("target") == 1
    n = rows.agg(F.count_distinct(user).alias("n_all"), F.count_distinct(F.when(hit, F.col(user))).alias("n_fore"))
    pairs = rows.select(user, "target", F.explode("tokens").alias("hits")).groupBy("hits", user).agg(F.max(hit.cast("int")).alias("t"))
    per = pairs.groupBy("hits").agg(F.count("*").alias("users"), F.sum("t").alias("fore_users")).where(F.col("users") >= least_users)
    per = per.crossJoin(F.broadcast(n)).select("hits", "users", (F.try_divide(F.col("fore_users"), "n_fore") * 100).alias("foreground"), (F.col("users") / F.col("n_all") * 100).alias("background"))
    per = per.fillna(0.0, ["foreground"]).withColumns({"lift": F.pow(F.col("foreground") / F.col("background"), F.lit(power)), "diff": F.col("foreground") - F.col("background")})
    return per.withColumn("jlh", F.col("lift") * F.col("diff"))


def word_lift(rows: DataFrame, inside: Column, least: int = 10) -> DataFrame:
    """hits, hitrate, occurrence_in, occurrence_all, direction, improvement and their product for words (column
    ``hits``) of more than ``least`` rows; the global rate is that of those rows."""
    per = rows.groupBy("hits").agg(F.sum(inside.cast("long")).alias("occurrence_in"), F.count("*").alias("occurrence_all")).where(F.col("occurrence_all") > least)
    rate = per.agg((F.sum("occurrence_in") / F.sum("occurrence_all")).alias("global_hitrate"))
    per = per.crossJoin(F.broadcast(rate)).withColumn("hitrate", F.col("occurrence_in") / F.col("occurrence_all"))
    per = per.withColumns({"direction": F.col("hitrate") - F.col("global_hitrate"), "improvement": F.try_divide("hitrate", "global_hitrate")})
    return per.withColumn("improvement_times_occurrence", F.col("occurrence_in") * F.col("improvement"))


def related(vectors: DataFrame, queries: DataFrame, n: int, key: str = "word", vector: str = "vector") -> DataFrame:
    """(word, score, n_queries): the words nearest to the query words by summed cosine, best n. The cosines of a word
    with all queries sum to its product with the sum of their unit vectors, one row, so nothing is paired; a query word
    itself counts for the others alone."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    unit = lambda df: df.withColumn("_norm", norm).where("_norm > 0").select(key, F.transform(vector, lambda x: x.cast("double") / F.col("_norm")).alias("_v"))
    places = unit(queries).select(F.posexplode("_v").alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    whole = places.agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"]).alias("_sum"))
    whole = whole.crossJoin(F.broadcast(unit(queries).agg(F.count("*").alias("_n"))))
    asked = queries.select(F.col(key).alias("_asked")).distinct()
    rows = unit(vectors).crossJoin(F.broadcast(whole)).join(asked, F.col(key) == F.col("_asked"), "left").withColumn("_own", F.col("_asked").isNotNull().cast("int"))
    score = F.aggregate(F.zip_with("_v", "_sum", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x) - F.col("_own")
    out = rows.select(F.col(key).alias("word"), score.alias("score"), (F.col("_n") - F.col("_own")).alias("n_queries"))
    return rank.top_n(out, "score", n, "word")
