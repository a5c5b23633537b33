"""The registered queries at the smallest scale, against their SQL or for their shape."""

import pytest

from spindrift.llm import queries
from tests.compare import rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    found = queries.QUERIES[name](spark, FOLDER).toPandas()
    assert len(found)
    if name in queries.ORACLE_SQL:
        assert rows(found) == rows(sql_rows(queries.ORACLE_SQL[name], FOLDER))


@pytest.mark.parametrize("name", ["op3_licences", "op4_sharding", "op10_pii"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("PythonUDF", "EvalPython", "MapInArrow", "InPandas"))


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.dtypes == docs.dtypes, name
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
