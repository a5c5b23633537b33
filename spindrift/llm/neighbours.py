"""Nearest neighbours by a block matrix join.

Vectors are dealt into blocks of bounded size, each one row of Arrow lists. Queries (ids divisible by ``every``) form
their own blocks; each meets every candidate block once (a stated query set against all rows, in blocks). A meeting is
one product tile of int8 codes: a vector is code * scale plus an error of known norm, so the tile bounds every distance
from both sides. Pairs whose lower bound exceeds the query's k-th smallest upper bound so far can't be among its
nearest; the others are recomputed in double precision and merged by a bounded heap a query. Each task keeps one heap a
query over all blocks it sees, and the heaps' few rows are ranked at the end. The result is exact.

Defined cases: null vectors, zero vectors, vectors with a null or non-finite component, rows with a null id, and rows
of another length than ``dim`` (if given) or than most take no part; repeated ids are candidates as often as they
occur, except for the query's own id; ties go to the smaller id; an empty table gives an empty result; other columns
are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK, QUERY_BLOCK = 2048, 256
#: Query blocks whose heaps a task holds at a time; with more, the oldest heap's rows are passed on (and ranked later).
HELD = 64
BLOCKED = "part long, ids array<long>, dim int, vectors array<double>"
FOUND = "query_id long, vec_id long, score double"


def usable(df: DataFrame, dim: int | None) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and v is not null")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(finite & F.exists("v", lambda x: x != 0))
    if dim is None:
        top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
        dim = top[0] if top else 0
    return rows.where(F.size("v") == dim)


def blocked(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of at most ``size`` vectors, numbered from the task's own start: no two blocks of a table share a number."""
    n = TaskContext.get().partitionId() << 32 if TaskContext.get() else 0
    for batch in batches:
        for i in range(0, batch.num_rows, size):
            part = batch.slice(i, size)
            ids, v = part.column(0), part.column(1)
            flat = v.flatten()
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids), pa.array([len(flat) // max(1, len(ids))], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)],
                names=["part", "ids", "dim", "vectors"],
            )
            n += 1


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, a scale for each row, and the norm of each row's error."""
    scale = np.maximum(np.abs(x).max(axis=1), np.finfo(float).tiny) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(x - codes * scale[:, None], axis=1)


def tile_bounds(q: tuple, c: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all distances between two quantised blocks. The product of codes is exact: below
    2**24 for up to 1040 components, so float32 multiplication may be used for it."""
    (qc, qs, qe), (cc, cs, ce) = q, c
    kind = np.float32 if qc.shape[1] <= 1040 else np.float64
    dots = (qc.astype(kind) @ cc.astype(kind).T).astype(np.float64)
    qn = (qc.astype(np.float64) ** 2).sum(1) * qs**2
    cn = (cc.astype(np.float64) ** 2).sum(1) * cs**2
    square = qn[:, None] + cn[None, :] - 2 * dots * qs[:, None] * cs[None, :]
    slack = 1e-9 * (qn[:, None] + cn[None, :])
    error = qe[:, None] + ce[None, :]
    low = np.sqrt(np.maximum(square - slack, 0)) * (1 - 1e-12) - error
    high = np.sqrt(np.maximum(square + slack, 0)) * (1 + 1e-12) + error
    return low, high


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of paired rows, summed in the order of the components."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += (a[:, d] - b[:, d]) ** 2
    return np.sqrt(total)


def searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows of (query block, candidate block) to the k nearest of each query over all rows of the task."""
    place: dict[int, dict] = {}  # of a query block: its vectors, and a heap of the best scores and ids for each query
    for batch in batches:
        cols = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        for r in range(batch.num_rows):
            key = cols["q_key"][r].as_py()
            if key not in place:
                if len(place) >= HELD:
                    yield heap_rows(place.pop(next(iter(place))))
                ids = np.asarray(cols["q_ids"][r].values.to_numpy(zero_copy_only=False))
                x = cols["q_vectors"][r].values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
                place[key] = {"ids": ids, "x": x, "codes": quantised(x), "score": np.full((len(ids), k), np.inf), "id": np.full((len(ids), k), np.iinfo(np.int64).max)}
            q = place[key]
            ids = np.asarray(cols["ids"][r].values.to_numpy(zero_copy_only=False))
            x = cols["vectors"][r].values.to_numpy(zero_copy_only=False).reshape(len(ids), -1)
            low, high = tile_bounds(q["codes"], quantised(x))
            own = q["ids"][:, None] == ids[None, :]
            high[own] = np.inf
            low[own] = np.inf
            kth = np.partition(high, k - 1, axis=1)[:, k - 1] if len(ids) >= k else np.full(len(q["ids"]), np.inf)
            limit = np.minimum(kth, q["score"][:, -1])
            a, b = np.nonzero((low <= limit[:, None]) & ~own)
            if not len(a):
                continue
            score = exact(q["x"][a], x[b])
            ends = np.searchsorted(a, np.arange(len(q["ids"]) + 1))
            for i in np.flatnonzero(np.diff(ends)):
                span = slice(ends[i], ends[i + 1])
                s, n = np.concatenate([q["score"][i], score[span]]), np.concatenate([q["id"][i], ids[b[span]]])
                best = np.lexsort((n, s))[:k]
                q["score"][i], q["id"][i] = s[best], n[best]
    for q in place.values():
        yield heap_rows(q)


def heap_rows(q: dict) -> pa.RecordBatch:
    good = np.isfinite(q["score"])
    return pa.RecordBatch.from_arrays([pa.array(np.repeat(q["ids"], good.sum(1))), pa.array(q["id"][good]), pa.array(q["score"][good])], names=["query_id", "vec_id", "score"])


def nearest(df: DataFrame, k: int = 10, every: int = 100, dim: int | None = None, spread: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of each query, exactly.

    Candidate blocks are dealt over ``spread`` groups (default: the session's shuffle partitions); the query blocks are
    copied to each group, so that one task sees all query blocks against its group of candidates, one after another."""
    spark = df.sparkSession
    rows = usable(df, dim)
    spread = spread or int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = rows.mapInArrow(lambda b: blocked(b, BLOCK), BLOCKED).withColumn("grp", F.pmod(F.xxhash64("part"), F.lit(spread)))
    queries = (
        rows.where(F.col("vec_id") % every == 0)
        .mapInArrow(lambda b: blocked(b, QUERY_BLOCK), BLOCKED)
        .select(F.col("part").alias("q_key"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
        .withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))))
    )
    met = queries.join(candidates.select("grp", "ids", "vectors"), "grp").select("q_key", "q_ids", "q_vectors", "ids", "vectors")
    found = met.mapInArrow(lambda b: searched(b, k), FOUND)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE = """
WITH ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: x <> 0)) > 0
), d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
  FROM ok q JOIN ok c ON q.vec_id <> c.vec_id AND q.vec_id % 100 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= 10
"""
