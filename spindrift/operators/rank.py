"""Global ranks without a global window.

A window without partitions sends all rows to one task. Here the rows themselves are range-partitioned by (metric,
value, key), numbered within their partition, and shifted by the totals of the partitions before, one row each. Rows keep
their key throughout, so ranks go home by one shuffle on the key; no value is a join key, however many rows share it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.sources.session import fixed


def free_name(columns: list[str], name: str) -> str:
    """A column name that is not among ``columns`` (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def ranged(rows: DataFrame, order: list, part: str) -> DataFrame:
    """``rows`` range-partitioned by ``order`` and written, with the number of their partition in ``part``: every reader
    sees the same partitions."""
    return fixed(rows.repartitionByRange(*order).withColumn(part, F.spark_partition_id()))


def ranked(rows: DataFrame) -> DataFrame:
    """m, k, rank of ``rows`` (m, g, s, k: metric, group, score, key): the percent rank of s among those of its metric and
    group, NULLs first. Rows of one score may lie in several partitions; how many rows come before the first of them is
    carried along the partitions' boundary rows, of which there is one a (partition, metric, group)."""
    placed = ranged(rows, [F.asc("m"), F.asc_nulls_first("g"), F.asc_nulls_first("s"), F.asc_nulls_first("k")], "p")
    local = placed.withColumn("local", F.rank().over(Window.partitionBy("p", "m", "g").orderBy(F.asc_nulls_first("s"))) - 1)
    score = F.struct("s")  # so that NULL is a value, and the least
    ends = local.groupBy("p", "m", "g").agg(F.count("*").alias("n"), F.min(score).alias("lo"), F.max(score).alias("hi"), F.max("local").alias("below"))
    group = Window.partitionBy("m", "g")
    along = group.orderBy("p")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumns({"before": F.coalesce(F.sum("n").over(earlier), F.lit(0)), "total": F.sum("n").over(group), "goes_on": F.coalesce(F.col("lo") == F.lag("hi").over(along), F.lit(False))})
    begun = F.when(~(F.col("goes_on") & (F.col("lo") == F.col("hi"))), F.col("before") + F.col("below"))
    ends = ends.withColumn("begun", begun).withColumn("first", F.when(F.col("goes_on"), F.last("begun", ignorenulls=True).over(earlier)))
    ends = ends.select(F.col("p").alias("p2"), F.col("m").alias("m2"), F.col("g").alias("g2"), "lo", "before", "total", "first")
    out = local.join(ends, (F.col("p") == F.col("p2")) & (F.col("m") == F.col("m2")) & F.col("g").eqNullSafe(F.col("g2")))
    place = F.when(F.col("first").isNotNull() & (score == F.col("lo")), F.col("first")).otherwise(F.col("before") + F.col("local"))
    return out.select("m", "k", F.when(F.col("total") > 1, place / (F.col("total") - 1)).otherwise(0.0).alias("rank"))


def percent_ranks(df: DataFrame, scores: list[str], by: str | None = None, key: str | None = None) -> DataFrame:
    """``percent_rank`` of each score over all rows (or over each value of ``by``, say a run's timestamp), as columns
    ``<score>_rank``: ties share, NULLs come first, one row alone has 0. All scores take one pass. ``key`` names a column
    that is unique and never NULL; without one, rows are written once with a number of their own."""
    number = free_name(df.columns, "_number")
    if key is None:
        df, key = fixed(df.withColumn(number, F.monotonically_increasing_id())), number
    metric = [F.struct(F.lit(i).alias("m"), F.col(s).cast("double").alias("s")) for i, s in enumerate(scores)]
    long = df.select(F.col(key).alias("k"), (F.col(by) if by else F.lit(0)).alias("g"), F.explode(F.array(*metric)).alias("v")).select("v.m", "g", "v.s", "k")
    back = ranked(long).groupBy("k").agg(*[F.max(F.when(F.col("m") == i, F.col("rank"))).alias(f"{s}_rank") for i, s in enumerate(scores)])
    back = back.withColumnRenamed("k", free_name([*df.columns, *back.columns], "_key"))
    return df.join(back, df[key] == back[back.columns[0]]).drop(back.columns[0], number)


def ntiles(df: DataFrame, score: str, tie: str, k: int, name: str = "bucket") -> DataFrame:
    """``ntile(k)`` over (score descending, tie): the first n mod k buckets have one row more."""
    part, before, total = (free_name(df.columns, x) for x in ("_part", "_before", "_total"))
    order = [F.desc(score), F.asc(tie)]
    placed = ranged(df, order, part)
    sizes = placed.groupBy(part).agg(F.count("*").alias(total))
    all_parts = Window.orderBy(part)  # one row a partition
    shift = sizes.select(part, (F.sum(total).over(all_parts) - F.col(total)).alias(before), F.sum(total).over(all_parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(total))
    rows = placed.join(F.broadcast(shift), part)
    p = F.col(before) + F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    q, r = F.call_function("div", F.col(total), F.lit(k)), F.col(total) % k
    big = r * (q + 1)
    bucket = F.when(p < big, F.call_function("div", p, q + 1)).otherwise(r + F.call_function("div", p - big, F.greatest(q, F.lit(1)))) + 1
    return rows.withColumn(name, bucket.cast("int")).drop(part, before, total)


def top_n(df: DataFrame, score: str, n: int, tie: str) -> DataFrame:
    """The n best rows, merged from each task's best."""
    return df.orderBy(F.desc(score), F.asc(tie)).limit(n)
