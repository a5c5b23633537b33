"""Shared helpers of this subpackage: tables cut from their lineage, and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset (tests on one machine), a new temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = tempfile.mkdtemp(prefix="spindrift-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: no lineage, and every reader sees the same rows. Options
    are those of writing Parquet."""
    path = f"{shared_dir(df.sparkSession)}/spindrift/{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(columns: list[str], name: str) -> str:
    """A column name that is not among ``columns`` (in any case of letters)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Rows (node, component): the smallest node that each node of an undirected edge list can reach.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Only minima are aggregated, so that a node
    with very many neighbours is pre-aggregated before each shuffle; nothing is gathered on the driver but two counts.
    Self-loops and null ends are ignored; an empty edge list gives an empty table.
    """
    e = cut(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == mark:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        mark, few = tuple(now), max(8, now[0] // 100_000)  # few tasks for few edges
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m")).coalesce(few)
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(few).distinct().coalesce(few)
        small = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(few)
        e = cut(
            large.join(small, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u != v")
            .coalesce(few)
            .distinct()
            .coalesce(few)
        )
    raise RuntimeError("connected components did not settle")
