"""Session settings and what Python workers need."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def ship_package(spark: SparkSession) -> SparkSession:
    """Let the session's Python workers import this package from where the driver has it."""
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return spark


def local_session(cores: int = 8, **conf: str) -> SparkSession:
    """A session on one machine with the settings that the tests and the bench use. ANSI mode stays on."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("spindrift")
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """A new name below the folder of ``spark.checkpoint.dir``. Where that is unset, a session on one machine gets a
    temporary folder; on a cluster it is an error, as tasks and driver have no other place in common."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="spindrift-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/spindrift/{uuid.uuid4().hex}"


def fixed(df: DataFrame) -> DataFrame:
    """One reading of ``df`` for all that follows: a table in the shared folder, which outlives lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
