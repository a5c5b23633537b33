"""The machine's sums, its accuracy on rows it has not seen, and pairs that a linear model misses."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from spindrift.llm import toxicity
from spindrift.llm.words import utf8

LABELS = "doc_id long, quality int, toxic int, score double"
RNG = random.Random(3)
FILLER = ["".join(RNG.choice("abcdeghilmnorst") for _ in range(RNG.randint(2, 8))) for _ in range(300)]


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def test_machine_equals_the_double_sum():
    rng = np.random.default_rng(1)
    m = toxicity.Machine(np.arange(6), rng.uniform(0.5, 2, 6), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    x = rng.uniform(0, 2, (4, 6)) * (rng.random((4, 6)) < 0.6)
    rows, at = np.nonzero(x)
    y = x / m.scale
    want = [0.3 + m.weights @ r + sum(m.factors[i] @ m.factors[j] * r[i] * r[j] for i in range(6) for j in range(i + 1, 6)) for r in y]
    assert np.allclose(toxicity.raw_scores(m, rows, at, x[rows, at], 4), want)


def test_terms_are_words_and_their_beginnings():
    data, offsets = utf8(pa.array(["Idiots! idiot", "", "ab"]))
    term, rows, words = toxicity.terms(data, offsets)
    assert words.tolist() == [2, 0, 1]
    first = [set(term[rows == r].tolist()) for r in range(3)]
    assert len(first[0]) == 2 + 2 + 1  # two words; 4 and 5 bytes shared, 6 bytes of the first
    assert not first[1] and len(first[2]) == 1


def texts(n, rng):
    """Toxic: an insult and a group in one text; either alone is clean."""
    rows, labels = [], []
    for i in range(n):
        kind = rng.randrange(4)
        w = [rng.choice(FILLER) for _ in range(40)]
        w += ["zorgling"] * (kind & 1) + ["harpfolk"] * (kind >> 1)
        rng.shuffle(w)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(kind == 3), 0.5))
    return rows, labels


def test_pairs_of_terms_are_learnt(spark, docs):
    rows, labels = texts(1500, random.Random(7))
    found = {r.doc_id: r for r in toxicity.score(docs(rows, extra=True), spark.createDataFrame(labels, LABELS), most_terms=64).collect()}
    unseen = [(found[i].predicted, y) for i, _, y, _ in labels if held(i)]
    assert all(found[i].held_out == held(i) for i, _ in rows)
    assert np.mean([a == b for a, b in unseen]) > 0.97  # no linear model of presence can pass 0.75 + (a threshold on the sum apart) with these
    assert {r.predicted for r in found.values()} == {0, 1}


def test_defined_cases(spark, docs):
    rows, labels = texts(300, random.Random(8))
    odd = [(1001, None), (1002, ""), (1003, "\n !!"), (None, "zorgling harpfolk"), (1004, "zorgling harpfolk " * 30_000), (1, "second text of one id"), (1005, "É\U0001f600")]
    table = spark.createDataFrame([*labels, (2, 1, None, 0.1), (None, 1, 1, 0.1), (3, 0, 0, 0.1), (3, 0, 1, 0.1)], LABELS)
    got = toxicity.score(docs(rows + odd, extra=True), table)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    found = got.collect()
    assert len(found) == len(rows + odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert len({r.score for r in found if r.doc_id in (1001, 1002, 1003, 1005)}) == 1
    none = toxicity.score(docs(rows[:3]), table.where("toxic = 0")).collect()
    assert [(r.score, r.predicted) for r in none] == [(0.0, 0)] * 3
    assert toxicity.score(docs([]), table).count() == 0
    assert toxicity.score(docs(rows[:2]), table.where("false")).count() == 2


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = toxicity.score(spark.read.parquet(f"{folder}/documents.parquet"), labels).join(labels, "doc_id").where("held_out").select("predicted", "toxic").toPandas()
    caught, right = found[found.toxic == 1].predicted.mean(), found[found.predicted == 1].toxic.mean()
    assert caught > 0.85 and right > 0.97, (caught, right)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_scores_do_not_depend_on_batches(n):
    m = toxicity.Machine(np.asarray([3, 9]), np.ones(2), -1.0, np.asarray([2.0, 1.0]), np.ones((2, 2)))
    rows = ["some words"] * n
    batch = pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(rows, pa.string()), pa.array([False] * n, pa.bool_())], names=["doc_id", "text", "held_out"])
    assert sum(b.num_rows for b in toxicity.scored(iter([batch]), m)) == n
