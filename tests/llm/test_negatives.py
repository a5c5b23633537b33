"""Hard negatives against all pairs, and the tree's ranges against all distances."""

import random

import numpy as np
import pytest

from spindrift.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, rank int, __leaf string"


def plain(rows, k=5, m=10):
    """Rows as the contract makes them from (vec_id, label, embedding)."""
    ok = []
    for i, label, v in rows:
        if i is None or label is None or v is None or not all(x is not None and np.isfinite(x) for x in v):
            continue
        ok.append((i, (label + 1) % 10 if i % 7 == 0 else label, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for i, label, v in ok:
        if i % 100:
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in ok if j != i))
        for s, j, _ in [x for x in scored if x[2] == label][:k]:
            window = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(window[:m])]
    return sorted(out)


def table(n, clusters, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.4, (clusters, 8))
    rows = [(i, int(rng.integers(0, 4)), (centre[i % clusters] * rng.uniform(0.5, 2) + rng.normal(0, 0.1, 8)).tolist()) for i in range(n)]
    rows += [(n + i, 1, rows[0][2]) for i in range(60)] + [(100, 2, rows[5][2]), rows[7], (n + 61, 3, [0.0] * 8)]
    return [*rows, (n + 62, None, rows[1][2]), (n + 63, 1, None), (n + 64, 1, [None] * 8), (n + 65, 1, [float("nan")] * 8), (n + 66, 1, [float("inf")] * 8), (None, 1, rows[1][2])]


@pytest.mark.parametrize(("clusters", "ways", "leaf_rows", "block"), [(1, 3, 20, 32), (12, 4, 10, 7)])
def test_hard_negatives(spark, monkeypatch, clusters, ways, leaf_rows, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    rows = table(700, clusters, clusters)
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    got = negatives.hard_negatives(negatives.contract_rows(df), ways=ways, leaf_rows=leaf_rows, per_leaf=4)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    want = plain(rows)
    assert sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got.collect()) == want and len(want) > 100


@pytest.mark.parametrize("rows", [[], [(100, 1, [1.0])], [(100, 1, [1.0]), (101, 1, [-1.0]), (102, 2, [0.5])], [(100, 1, None)]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = negatives.hard_negatives(negatives.contract_rows(df)).collect()
    assert sorted(map(tuple, got)) == plain(rows)


def test_tree_skips_leaves_but_loses_none():
    rng = np.random.default_rng(4)
    x = (rng.normal(0, 100, (6, 10))[rng.integers(0, 6, 900)] + rng.normal(0, 5, (900, 10))).round()
    square = float((x * x).sum(1).max())
    nodes = negatives.grown(negatives.lifted(x[:200], square), 4, 2)
    n_leaves = sum(len(n.points) for n in nodes if not n.children)

    def seen(node, side, d):
        for j in np.unique(side):
            node.low[:, j] = np.minimum(node.low[:, j], d[side == j].min(0))
            node.high[:, j] = np.maximum(node.high[:, j], d[side == j].max(0))

    leaf = negatives.walk(nodes, negatives.lifted(x, square), seen)
    q = np.concatenate([x[:50], np.zeros((50, 1))], axis=1)
    dist = negatives.distances(q, negatives.lifted(x, square))
    near, far = np.sort(dist, axis=1)[:, 5], np.sort(dist, axis=1)[:, 60]
    left = negatives.left_over(nodes, q, near - 1e-6, far + 1e-6, n_leaves)
    for i in range(50):
        assert set(leaf[(dist[i] >= near[i]) & (dist[i] <= far[i])]) <= set(np.flatnonzero(left[i]))
    assert left.mean() < 0.6
