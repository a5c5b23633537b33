"""A training corpus from the documents table: language, copies, benchmark leaks, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All but the last return the columns of documents:

1. language: documents without a letter, or whose letters the network holds for no language, go;
2. near_duplicates: of each group of near-duplicates (five-word shingles, similarity 0.8 or more) the smallest id stays;
3. decontamination: documents that contain a benchmark item, exactly or within its error budget, go;
4. personal_data: spans of personal data are replaced by their kinds;
5. packing: the documents' tokens in windows of 4096 (one row per piece).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from spindrift.llm.decontamination import drop_contaminated
from spindrift.llm.langid import keep_identified
from spindrift.llm.neardup import drop_near_duplicates
from spindrift.llm.packing import pack
from spindrift.llm.pii import mask
from spindrift.llm.shared import shared_dir
from spindrift.sources.session import ship_package


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_near_duplicates(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return mask(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return pack(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The trained stages (language, personal data) and edit distances have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = f"{folder}/{k}_{name}"
            out.write.parquet(path)
            out = spark.read.schema(out.schema).parquet(path)
        docs = out
    return docs
