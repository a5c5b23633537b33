"""The queries of this subpackage and, where SQL can express them, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from spindrift.llm import licences, negatives, neighbours, sharding
from spindrift.sources.session import ship_package


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.decontamination import find_leaks

    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.packing import pack

    return pack(read(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_documents(read(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf_dir, "documents"))


def op5_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.language_model import score

    return score(read(spark, sf_dir, "documents"))


def op6_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.extraction import extract

    return extract(read(spark, sf_dir, "pages"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.langid import identify

    return identify(read(spark, sf_dir, "documents"))


def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.neardup import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.pii import find_personal_data

    return find_personal_data(read(spark, sf_dir, "documents"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.contract_rows(read(spark, sf_dir, "embeddings")))


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.periodic import run_digests

    return run_digests(read(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindrift.llm.toxicity import score

    return score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_licences": op3_licences,
    "op4_sharding": op4_sharding,
    "op5_scoring": op5_scoring,
    "op6_extraction": op6_extraction,
    "op7_langid": op7_langid,
    "op8_neardup": op8_neardup,
    "op9_neighbours": op9_neighbours,
    "op10_pii": op10_pii,
    "op11_negatives": op11_negatives,
    "op12_runs": op12_runs,
    "op13_toxicity": op13_toxicity,
}

ORACLE_SQL: dict[str, str] = {
    "op3_licences": licences.oracle(),
    "op4_sharding": sharding.oracle(),
    "op9_neighbours": neighbours.ORACLE,
    "op11_negatives": negatives.ORACLE,
}
