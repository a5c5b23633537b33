"""Tables that are rewritten beside their readers and published by one small commit.

A table's folder holds ``data/<token>/_p=<partition>/`` (Parquet; the partition column is in the files too) and a log: for
each version one folder ``log/v=<number>/`` that lists the data folders of its partitions. A version exists once Spark's
writer has finished its log folder, so readers see the old rows until then and all new ones from then on; what a job
that died has written is in no version. A rewrite makes new folders for the partitions it changes and keeps the others'.
Two writers that start from one version write the same log folder: the second fails and can start again.

All of it goes through Spark's readers and writers, so any store that Spark reads will do. The log is read on the
driver: one row a live partition.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTRY = "part string, folder string"


def missing_path(e: AnalysisException) -> bool:
    return (e.getCondition() or "") == "PATH_NOT_FOUND"


class Log:
    """Numbered versions, each a small table, of which the largest finished one counts."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def versions(self) -> list[int]:
        """Numbers of the finished versions: those whose folder has the writer's mark or files."""
        try:
            found = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(self.path)
            names = found.select(F.regexp_extract(F.col("_metadata.file_path"), r"/v=(\d+)/part-[^/]*$", 1).alias("v")).where("v <> ''").distinct().collect()
        except AnalysisException as e:
            if missing_path(e):
                return []
            raise
        return sorted(int(r["v"]) for r in names)

    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/v={version}")

    def publish(self, version: int, entries: list[tuple]) -> None:
        """One file, so that the version appears at once; an error if there is such a version."""
        self.spark.createDataFrame(entries, self.schema).coalesce(1).write.mode("errorifexists").parquet(f"{self.path}/v={version}")


class VersionedTable:
    """A table of ``schema`` in partitions by the text of one column. Reads resolve the latest version when they are made."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType | str, partition: str):
        self.spark, self.path, self.partition = spark, path.rstrip("/"), partition
        self.schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.log = Log(spark, f"{self.path}/log", ENTRY)

    def entries(self, version: int | None = None) -> dict[str, str]:
        """Partition -> folder of a version (the latest)."""
        version = self.log.latest() if version is None else version
        return {} if version is None else {r["part"]: r["folder"] for r in self.log.read(version).collect() if r["part"] is not None}

    def read(self, low: str | None = None, high: str | None = None, version: int | None = None, only: Iterable[str] | None = None) -> DataFrame:
        """Rows of the partitions in [low, high] (by their text), or of some; the others' folders are not listed."""
        wanted = set(only) if only is not None else None
        folders = [f for p, f in self.entries(version).items() if (low is None or p >= low) and (high is None or p <= high) and (wanted is None or p in wanted)]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/{f}" for f in folders])

    def text(self) -> F.Column:
        return F.coalesce(F.col(self.partition).cast("string"), F.lit("__null__"))

    def _write(self, df: DataFrame) -> dict[str, str]:
        token = uuid.uuid4().hex
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields]).withColumn("_p", self.text())
        rows.write.partitionBy("_p").parquet(f"{self.path}/data/{token}")
        try:
            parts = self.spark.read.parquet(f"{self.path}/data/{token}").select(F.col("_p").cast("string")).distinct().collect()
        except AnalysisException as e:
            if (e.getCondition() or "").startswith("UNABLE_TO_INFER_SCHEMA"):  # no rows, no files
                return {}
            raise
        return {r["_p"]: f"data/{token}/_p={escaped(r['_p'])}" for r in parts}

    def _publish(self, found: dict[str, str], base: int | None) -> int:
        version = 0 if base is None else base + 1
        self.log.publish(version, sorted(found.items()) or [(None, None)])
        return version

    def replace(self, df: DataFrame) -> int:
        """All rows anew. ``df`` may read this table's versions."""
        base = self.log.latest()
        return self._publish(self._write(df), base)

    def append(self, df: DataFrame) -> int:
        """Rows of partitions that the table has not; others are an error."""
        base, new = self.log.latest(), self._write(df)
        old = self.entries(base) if base is not None else {}
        if both := sorted(set(old) & set(new)):
            raise ValueError(f"partitions exist: {both}")
        return self._publish(old | new, base)

    def upsert(self, updates: DataFrame, keys: list[str]) -> int:
        """Updates replace rows of the same keys, in whatever partition these are, and add the others. Only partitions
        that hold such keys or get rows are written anew. A key twice in the updates is an error."""
        if not updates.groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError("updates hold a key twice")
        base = self.log.latest()
        old = self.entries(base) if base is not None else {}
        into = {r[0] for r in updates.select(self.text()).distinct().collect()}
        held = {r[0] for r in self.read(version=base).join(updates.select(*keys), keys, "left_semi").select(self.text()).distinct().collect()} if old else set()
        touched = self.read(version=base, only=into | held) if old else self.read(only=[])
        kept = touched.join(updates.select(*keys), keys, "left_anti").select(*self.schema.fieldNames())
        new = self._write(kept.unionByName(updates.select(*self.schema.fieldNames())))
        return self._publish({p: f for p, f in old.items() if p not in into | held} | new, base)

    def keep_days(self, days: int, least: int = 0) -> int | None:
        """Drops partitions of days before the latest one less ``max(days, least)``: a new log entry and nothing else."""
        base = self.log.latest()
        old = self.entries(base) if base is not None else {}
        known = [p for p in old if p != "__null__"]
        if not known:
            return base
        first = (dt.date.fromisoformat(max(known)) - dt.timedelta(days=max(days, least))).isoformat()
        return self._publish({p: f for p, f in old.items() if p != "__null__" and p >= first}, base)


def escaped(value: str) -> str:
    """A partition value as Spark names its folder."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in '"#%\'*/:=?\\\x7f{[]^' else c for c in value)
