"""Every query of the library proper against its SQL, at the smallest scale."""

import pytest

from spindrift.plans import queries as plans
from tests.compare import rows, sql_rows

FOLDER = "/root/testdata/sf0.001"


def scores_and_ranks(found):
    """Scores in 0..1 with the percent ranks that a plain sort gives; a model that is missing has the constant given."""
    assert len(found) == 500 and found.user_id.is_unique
    for c in [c for c in found.columns if c.endswith("_probability")]:
        p, r = found[c], found[c.replace("probability", "percentile")]
        if p.isna().all() or (p == -1).all():
            assert r.isna().all() or (r == -1).all()
        elif not c.startswith("female"):
            assert p.between(0, 1).all() and p.nunique() > 400
            assert ((p.rank(method="min") - 1) / (len(p) - 1) - r).abs().max() < 1e-9
    if "female_probability" in found:
        assert ((found.female_probability + found.male_probability) - 1).abs().max() < 1e-12


def weights(found):
    assert len(found) == 64 and found.importance.notna().all() and found.importance.abs().sum() > 0 and found.feature.is_unique


def saved_scores(found):
    assert len(found) > 50 and found.same.all() and found.quality_probability.between(0, 1).all()
    p = found.quality_probability
    assert ((p.rank(method="min") - 1) / (len(p) - 1) - found.quality_percentile).abs().max() < 1e-9


def tree_weights(found):
    assert set(found["column"]) == {"n_chars", "n_words", "blank_flag", "lang", "source"} and found.feature.is_unique
    assert abs(found.importance.sum() - 1) < 1e-9 and (found.importance >= 0).all()


def nearest_words(found):
    assert len(found) == 9 and found.groupby("asked").size().eq(3).all() and found.score.abs().le(1 + 1e-9).all() and (found.word != found.asked).all()


#: What must hold for queries without SQL.
CHECKS = {"saved_model_score": saved_scores, "saved_model_importance": tree_weights, "word_synonyms": nearest_words, "lookalike_score": scores_and_ranks, "sociodemo_score": scores_and_ranks, "feature_importance": weights}


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, name):
    found = plans.QUERIES[name](spark, FOLDER).toPandas()
    spark.catalog.clearCache()
    if name in plans.ORACLE_SQL:
        assert rows(found) == rows(sql_rows(plans.ORACLE_SQL[name], FOLDER))
    else:
        CHECKS[name](found)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(1).count() == 1
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
