"""Hard negatives by a geometric near-neighbour access tree (GNAT, Brin 1995) over inner products.

An inner product window is an annulus: with M the largest norm of all rows, a row x gets the further component
sqrt(M^2 - |x|^2) and an anchor q gets 0, so that |q - x|^2 = |q|^2 + M^2 - 2 <q, x>. The tree's nodes hold ``ways`` split
points; a row goes to the nearest one's subtree (the generalised hyperplanes between them). Split points come from a
bounded sample (``per_leaf`` rows a leaf, by a hash of the row), picked far from each other; every row of the table is
routed, and for each pair (split point i, subtree j) the range of distances from i to all rows below j is kept. An
anchor's annulus skips subtree j if for any i the range (i, j) misses the distances that the triangle inequality allows.

1. Rows are routed, numbered and written once, by leaf; ranges and leaf sizes are summed over all rows.
2. Positives: an anchor's five best rows of its label. The sample's fifth best bounds the annulus from the start.
3. Negatives: for each (anchor, positive) the best rows of other labels within the window; the sample bounds it likewise.

In both searches anchors travel in blocks to the leaves that are left for them, and meet these leaves' rows in blocks
(a stated query set against all rows, in blocks; leaves that hold many rows are split over tasks). In a leaf all inner
products are computed exactly and merged into bounded lists; the lists' few rows are ranked at the end. So the result
is exact; the sample and the tree's shape only decide how much work is left out.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, and rows of another length
than most take no part; zero vectors do; two anchor rows of one id are two anchors; repeated rows count as often as
they occur, but rows of the anchor's own id never do; a window of a negative positive score is empty; ties go to the
smaller id; inner products must stay below 2**53; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spindrift.llm.shared import cut

BLOCK, ANCHORS = 2048, 256
ROUTED = "row long, vec_id long, label long, v array<long>, leaf int"
#: A window's number, and a block of candidates found for it.
FOUND = "anchor long, place int, vec_id long, score long"
LOWEST = np.iinfo(np.int64).min // 4


@dataclass
class Node:
    """Split points (with the further component) and, for each pair, the range of distances; children or leaf numbers."""

    points: np.ndarray
    children: list[Node] = field(default_factory=list)
    number: int = 0  # in order of the walk
    first_leaf: int = 0
    low: np.ndarray | None = None  # (split point, subtree)
    high: np.ndarray | None = None


def lifted(v: np.ndarray, square: float) -> np.ndarray:
    """Rows with the component that gives all of them the norm sqrt(square)."""
    return np.concatenate([v, np.sqrt(np.maximum(square - (v * v).sum(1), 0))[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1) - 2 * (a @ b.T), 0))


def spread_points(x: np.ndarray, ways: int) -> np.ndarray:
    """``ways`` rows far from each other: each next one is the farthest from those taken."""
    taken = [int(np.argmax(np.linalg.norm(x - x.mean(0), axis=1)))]
    near = np.linalg.norm(x - x[taken[0]], axis=1)
    while len(taken) < min(ways, len(x)) and near.max() > 0:
        taken.append(int(near.argmax()))
        near = np.minimum(near, np.linalg.norm(x - x[taken[-1]], axis=1))
    return x[taken]


def grown(sample: np.ndarray, ways: int, depth: int) -> list[Node]:
    """The nodes of a tree over the sample, root first; leaves are numbered from 0."""
    nodes: list[Node] = []
    leaves = 0

    def grow(x: np.ndarray, level: int) -> Node:
        nonlocal leaves
        node = Node(spread_points(x, ways), number=len(nodes))
        nodes.append(node)
        m = len(node.points)
        node.low, node.high = np.full((m, m), np.inf), np.full((m, m), -np.inf)
        if level + 1 == depth:
            node.first_leaf = leaves
            leaves += m
        else:
            side = distances(x, node.points).argmin(1)
            node.children = [grow(x[side == j] if (side == j).any() else node.points[j : j + 1], level + 1) for j in range(m)]
        return node

    if len(sample):
        grow(sample, 0)
    return nodes


def walk(nodes: list[Node], x: np.ndarray, seen=None) -> np.ndarray:
    """The leaf of each row; ``seen`` gets (node, subtree of each row, distances to the node's split points)."""
    leaf = np.zeros(len(x), np.int32)

    def down(node: Node, at: np.ndarray) -> None:
        d = distances(x[at], node.points)
        side = d.argmin(1)
        if seen:
            seen(node, side, d)
        if not node.children:
            leaf[at] = node.first_leaf + side
            return
        for j, child in enumerate(node.children):
            if (side == j).any():
                down(child, at[side == j])

    if len(x):
        down(nodes[0], np.arange(len(x)))
    return leaf


def left_over(nodes: list[Node], q: np.ndarray, near: np.ndarray, far: np.ndarray, n_leaves: int) -> np.ndarray:
    """(anchors, leaves): whether a row at a distance within [near, far] of the anchor can be in the leaf."""
    out = np.zeros((len(q), n_leaves), bool)

    def down(node: Node, at: np.ndarray) -> None:
        d = distances(q[at], node.points)
        least = np.maximum(d - far[at, None], near[at, None] - d)
        most = d + far[at, None]
        keep = ((most[:, :, None] >= node.low) & (least[:, :, None] <= node.high)).all(1)  # an empty subtree's range is inf..-inf
        for j in range(len(node.points)):
            own = at[keep[:, j]]
            if not len(own):
                continue
            if node.children:
                down(node.children[j], own)
            else:
                out[own, node.first_leaf + j] = True

    if len(q) and nodes:
        down(nodes[0], np.arange(len(q)))
    return out


def matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(n, -1) if n else np.zeros((0, 0), kind)


@dataclass
class Tree:
    nodes: list[Node]
    leaves: int
    square: float  # of the largest norm
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]  # ids, labels, vectors
    splits: np.ndarray | None = None  # of each leaf: the tasks that its rows are dealt over

    def radius(self, scores: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The distance at which a row has this inner product with its anchor."""
        return np.sqrt(np.maximum((q * q).sum(1) + self.square - 2.0 * scores, 0))


def usable(df: DataFrame) -> DataFrame:
    """vec_id, label, v (array<long>) of the rows that take part, of the most frequent length."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("v").alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull())
    )
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("v") == (top[0] if top else 0))


def contract_rows(df: DataFrame) -> DataFrame:
    """vec_id, label, v of an embeddings table: components become floor(256 * x), labels of ids divisible by 7 move on by one."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return df.where(finite).select("vec_id", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label"), F.transform(v, lambda x: F.floor(256 * x)).alias("v"))


def planted(rows: DataFrame, ways: int, leaf_rows: int, per_leaf: int, most_depth: int) -> Tree:
    """The tree's shape, from a sample of at most ``per_leaf`` * ``ways`` ** ``most_depth`` rows."""
    size = rows.agg(F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x))).first()
    depth = 1
    while depth < most_depth and size[0] > leaf_rows * ways**depth:
        depth += 1
    got = rows.orderBy(F.xxhash64("vec_id", "label", "v"), "vec_id", "label").limit(per_leaf * ways**depth).collect()
    v = np.asarray([r["v"] for r in got], np.float64).reshape(len(got), len(got[0]["v"]) if got else 0)
    nodes = grown(lifted(v, size[1] or 0.0), ways, depth)
    return Tree(nodes, sum(len(n.points) for n in nodes if not n.children), size[1] or 0.0, (np.asarray([r["vec_id"] for r in got], np.int64), np.asarray([r["label"] for r in got], np.int64), v))


def routed(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        leaf = walk(tree.nodes, lifted(matrix(batch.column("v")), tree.square))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], names=[*batch.schema.names, "leaf"])


def ranges(batches: Iterator[pa.RecordBatch], tree: Tree) -> Iterator[pa.RecordBatch]:
    """A task's ranges (node, split point, subtree, low, high) and, as node -1, its numbers of rows by leaf."""
    size = np.zeros(tree.leaves)

    def seen(node: Node, side: np.ndarray, d: np.ndarray) -> None:
        for j in np.unique(side):
            own = d[side == j]
            node.low[:, j] = np.minimum(node.low[:, j], own.min(0))
            node.high[:, j] = np.maximum(node.high[:, j], own.max(0))

    for batch in batches:
        size += np.bincount(walk(tree.nodes, lifted(matrix(batch.column("v")), tree.square), seen), minlength=tree.leaves)
    rows = [(-1, -1, int(leaf), n, n) for leaf, n in enumerate(size) if n]
    for node in tree.nodes:
        rows += [(node.number, int(i), int(j), float(node.low[i, j]), float(node.high[i, j])) for i, j in np.argwhere(np.isfinite(node.low))]
    yield pa.RecordBatch.from_pylist([dict(zip(("node", "i", "j", "low", "high"), r, strict=True)) for r in rows], schema=pa.schema([("node", pa.int32()), ("i", pa.int32()), ("j", pa.int32()), ("low", pa.float64()), ("high", pa.float64())]))


def measured(tree: Tree, rows: DataFrame, block: int) -> Tree:
    """The tree with its ranges and leaf sizes over all rows: as many numbers as the tree has, whatever the table's size."""
    found = rows.select("v").mapInArrow(lambda b: ranges(b, tree), "node int, i int, j int, low double, high double")
    slack = 1e-9 * np.sqrt(tree.square) + 1e-9
    tree.splits = np.ones(tree.leaves, np.int64)
    for r in found.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("low").alias("n")).collect():
        if r["node"] < 0:
            tree.splits[r["j"]] = max(1, -(-int(r["n"]) // block))
        else:
            node = tree.nodes[r["node"]]
            node.low[r["i"], r["j"]], node.high[r["i"], r["j"]] = r["low"] - slack, r["high"] + slack
    return tree


def kth_in_sample(tree: Tree, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int) -> np.ndarray:
    """The k-th best score among the sample's rows that count for a window, or the window's low end: no answer is below it."""
    s_ids, s_labels, s = tree.sample
    score = q @ s.T
    good = ((labels[:, None] == s_labels) == same) & (ids[:, None] != s_ids) & (score >= low[:, None]) & (score <= high[:, None])
    score = np.where(good, score, LOWEST)
    return np.maximum(np.partition(score, -k, axis=1)[:, -k] if score.shape[1] >= k else LOWEST, low)


def dispatched(batches: Iterator[pa.RecordBatch], tree: Tree, same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Windows (anchor, place, low, high, with the anchor's id, label and vector) to blocks for the leaves left to them.
    A leaf's ``part``s share its blocks of rows."""
    for batch in batches:
        for begin in range(0, batch.num_rows, ANCHORS):
            part = batch.slice(begin, ANCHORS)
            cols = {n: part.column(n).to_numpy(zero_copy_only=False) for n in ("anchor", "place", "vec_id", "label", "low", "high")}
            q = matrix(part.column("v"))
            low = kth_in_sample(tree, cols["vec_id"], cols["label"], q, cols["low"], cols["high"], same, k)
            slack = 1e-9 * np.sqrt(tree.square) + 1e-9
            open_ = np.flatnonzero(low <= cols["high"])
            near, far = tree.radius(np.minimum(cols["high"].astype(float), np.sqrt(tree.square * (q * q).sum(1))), q) - slack, tree.radius(np.where(low > LOWEST, low, -np.sqrt(tree.square * (q * q).sum(1))), q) + slack
            lifted_q = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
            keep = left_over(tree.nodes, lifted_q[open_], near[open_], far[open_], tree.leaves)
            for leaf in np.flatnonzero(keep.any(0)):
                own = pa.array(open_[keep[:, leaf]])
                block = part.take(own)
                low_own = pa.array(low[own.to_numpy()].astype(np.int64))
                flat, n = block.column("v").flatten(), len(own)
                parts = int(tree.splits[leaf])
                one = lambda x, m=n: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                lists = [one(block.column(c)) for c in ("anchor", "place", "vec_id", "label")] + [one(low_own), one(block.column("high")), one(flat)]
                for p in range(parts):
                    yield pa.RecordBatch.from_arrays([pa.array([leaf], pa.int32()), pa.array([p], pa.int32()), *lists], names=["leaf", "part", "anchor", "place", "own_id", "own_label", "low", "high", "vectors"])


DISPATCHED = "leaf int, part int, anchor array<long>, place array<int>, own_id array<long>, own_label array<long>, low array<long>, high array<long>, vectors array<long>"


def blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by leaf and part, to one row a stretch of at most BLOCK."""
    for batch in batches:
        leaf, part = (batch.column(c).to_numpy() for c in ("leaf", "part"))
        cuts = np.flatnonzero((leaf[1:] != leaf[:-1]) | (part[1:] != part[:-1])) + 1
        edges = [0, *cuts.tolist(), len(leaf)]
        for a, z in zip(edges[:-1], edges[1:], strict=True):
            for i in range(a, z, BLOCK):
                own = batch.slice(i, min(BLOCK, z - i))
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (own.column("vec_id"), own.column("label"), own.column("v").flatten())]
                yield pa.RecordBatch.from_arrays([pa.array([leaf[i]], pa.int32()), pa.array([part[i]], pa.int32()), *lists], names=["leaf", "part", "ids", "labels", "rows"])


BLOCKED = "leaf int, part int, ids array<long>, labels array<long>, rows array<long>"


def met(batches: Iterator[pa.RecordBatch], same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Each row: a block of windows and a block of candidates of one leaf, to the windows' k best candidates."""
    for batch in batches:
        for r in range(batch.num_rows):
            cell = lambda name, b=batch, i=r: b.column(b.schema.get_field_index(name))[i].values.to_numpy(zero_copy_only=False)
            ids, labels, own, own_labels, low, high = (cell(c) for c in ("ids", "labels", "own_id", "own_label", "low", "high"))
            score = cell("vectors").astype(np.float64).reshape(len(own), -1) @ cell("rows").astype(np.float64).reshape(len(ids), -1).T
            if np.abs(score).max(initial=0) >= 2.0**53:
                raise OverflowError("an inner product is 2**53 or more")
            good = ((own_labels[:, None] == labels) == same) & (own[:, None] != ids) & (score >= low[:, None]) & (score <= high[:, None])
            if score.shape[1] > k:  # scores below the k-th best go at once
                kth = np.partition(np.where(good, score, LOWEST), -k, axis=1)[:, -k]
                good &= score >= kth[:, None]
            a, b = np.nonzero(good)
            s = score[a, b].astype(np.int64)
            order = np.lexsort((ids[b], -s, a))
            a, b, s = a[order], b[order], s[order]
            first = np.searchsorted(a, a)
            top = np.arange(len(a)) - first < k
            a, b, s = a[top], b[top], s[top]
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(cell("anchor")[a]), pa.array(cell("place")[a]), pa.array(ids[b]), pa.array(s)], names=["anchor", "place", "vec_id", "score"])


def search(tree: Tree, candidates: DataFrame, windows: DataFrame, same: bool, k: int) -> DataFrame:
    """anchor, place, vec_id, score, rank of each window's k best rows (of the same label, or of others), exactly."""
    sent = windows.select("anchor", "place", "vec_id", "label", "low", "high", "v").mapInArrow(lambda b: dispatched(b, tree, same, k), DISPATCHED)
    pairs = sent.join(candidates, ["leaf", "part"]).select("anchor", "place", "own_id", "own_label", "low", "high", "vectors", "ids", "labels", "rows")
    found = pairs.mapInArrow(lambda b: met(b, same, k), FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(df: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, ways: int = 8, leaf_rows: int = 4096, per_leaf: int = 32, most_depth: int = 3) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for rows (vec_id, label, v: integers).

    Anchors are the rows whose id is divisible by ``every``; a negative's score lies within ``low`` and ``high`` percent
    of the positive's. The tree has up to ``ways`` ** ``most_depth`` leaves of some ``leaf_rows`` rows; fuller leaves are split."""
    rows = usable(df)
    tree = planted(rows, ways, leaf_rows, per_leaf, most_depth)
    if not tree.nodes:
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    kept = cut(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "label", "v").mapInArrow(lambda b: routed(b, tree), ROUTED))
    tree = measured(tree, kept, BLOCK)
    parts = F.element_at(F.array(*[F.lit(int(n)) for n in tree.splits]), F.col("leaf") + 1)
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("row"), parts).cast("int")).repartition("leaf", "part").sortWithinPartitions("leaf", "part")
    candidates = cut(dealt.select("leaf", "part", "vec_id", "label", "v").mapInArrow(blocked, BLOCKED))
    anchors = kept.where(F.col("vec_id") % every == 0).select(F.col("row").alias("anchor"), "vec_id", "label", "v")
    limit = F.lit(LOWEST).cast("long")
    found = cut(search(tree, candidates, anchors.select("*", F.lit(0).alias("place"), limit.alias("low"), (-limit).alias("high")), True, positives).select("anchor", F.col("rank").cast("int").alias("place"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
    windows = found.where("positive_score >= 0").join(anchors, "anchor")
    windows = windows.select("anchor", "place", "vec_id", "label", "v", F.expr(f"({low} * positive_score + 99) div 100").alias("low"), F.expr(f"{high} * positive_score div 100").alias("high"))
    best = search(tree, candidates, windows, False, negatives)
    return (
        best.select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
        .join(found, ["anchor", "place"])
        .join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
    )


ORACLE = """
WITH ok AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(CAST(embedding AS DOUBLE[]), lambda x: floor(256 * x)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS k FROM s WHERE same) WHERE k <= 5
), n AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.other_id) AS rank
  FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
