"""Toxicity by a factorization machine over hashed terms.

Terms are words (bytes of letters and digits, lower-cased) and their beginnings of several lengths, so that a stem
counts under any ending; a term is one of BUCKETS hash buckets. A text's value at a term is its count over the square
root of the text's number of words. The machine's score is

    w0 + sum_j w_j x_j + sum_{i<j} <v_i, v_j> x_i x_j

whose second sum sees pairs, such as an insult beside the mention of a group, that no single weight can.

Labels are learnt from a bounded sample: ``per_class`` labelled documents of each class at most, taken evenly by a hash
of their ids. Spark sums the sample's terms by class and keeps the ``terms`` ones whose means differ most (by Welch's
statistic); only the sample's values at these terms reach the driver, where Adam fits the machine in numpy. All whole
texts are then scored where they are read.

Defined cases: a null or empty text, or one without a word, has no term and gets the machine's constant; without a
labelled row of both classes every score is 0.0; a null doc_id counts as the empty string where ids are hashed and has
no label; of a document's several labels the largest counts, and of one id's several texts the least is learnt from; an
empty table gives an empty result; other columns are left out. Ids, labels, lang and source are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut
from spindrift.llm.words import LOWER, chunks, mix, powers, trimmed, utf8, word_spans

BUCKETS = 1 << 22
#: Bytes of the beginnings of words that are terms of their own, beside the word itself.
STEMS = (4, 5, 6, 7)
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


@dataclass
class Machine:
    buckets: np.ndarray  # sorted buckets of the terms
    scale: np.ndarray  # a term's usual value in texts that have it
    bias: float
    weights: np.ndarray  # (terms,)
    factors: np.ndarray  # (terms, k)


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every term, and the rows' numbers of words."""
    starts, ends, rows = word_spans(data, offsets, LETTERS)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    found, owner = [], []
    for size in (0, *STEMS):
        long = np.flatnonzero(ends - starts >= size) if size else slice(None)
        a = starts[long]
        b = a + size if size else ends
        found.append((mix((sums[b] - sums[a]) * down[a] + np.uint64(size)) & np.uint64(BUCKETS - 1)).astype(np.int32))
        owner.append(rows[long])
    return np.concatenate(found), np.concatenate(owner), np.bincount(rows, minlength=len(offsets) - 1)


def values(data: np.ndarray, offsets: np.ndarray, place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and value, once for each term of a row. Terms are buckets, or ``place``[bucket] where that is not -1."""
    found, rows, words = terms(data, offsets)
    if place is not None:
        found = place[found]
        rows, found = rows[found >= 0], found[found >= 0]
    key, count = np.unique(rows.astype(np.int64) * BUCKETS + found, return_counts=True)
    rows = key // BUCKETS
    return rows, key % BUCKETS, count / np.sqrt(words[rows])


def places(buckets: np.ndarray) -> np.ndarray:
    table = np.full(BUCKETS, -1, np.int16)
    table[buckets] = np.arange(len(buckets))
    return table


def raw_scores(m: Machine, rows: np.ndarray, at: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """The machine's value of each of n rows, given as (row, term, value)."""
    x = x / m.scale[at]
    z = m.bias + np.bincount(rows, m.weights[at] * x, n)
    for f in range(m.factors.shape[1]):
        vx = m.factors[at, f] * x
        z += 0.5 * (np.bincount(rows, vx, n) ** 2 - np.bincount(rows, vx * vx, n))
    return z


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def train(buckets: np.ndarray, rows: np.ndarray, at: np.ndarray, x: np.ndarray, y: np.ndarray, k: int = 4, seed: int = 5, epochs: int = 40, batch: int = 64, rate: float = 0.05, decay: float = 5e-4) -> Machine:
    """Adam on the logistic loss and ``decay`` times half the squared weights; ``rows`` are sorted, ``at`` are places in ``buckets``."""
    rng = np.random.default_rng(seed)
    n, d = len(y), len(buckets)
    total = np.bincount(at, x, d)
    scale = np.maximum(total / np.maximum(np.bincount(at, minlength=d), 1), 1e-9)
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    m = Machine(buckets, scale, float(np.log(share / (1 - share))), np.zeros(d), rng.normal(0, 0.01, (d, k)))
    first = [np.zeros(1), np.zeros(d), np.zeros((d, k))]
    second = [np.zeros(1), np.zeros(d), np.zeros((d, k))]
    bias, step = np.asarray([m.bias]), 0
    bounds = np.searchsorted(rows, np.arange(n + 1))
    v = x / scale[at]
    for epoch in range(epochs):
        pace = rate * (1 - epoch / epochs)
        order = rng.permutation(n)
        for i in range(0, n, batch):
            pick = order[i : i + batch]
            sizes = bounds[pick + 1] - bounds[pick]
            r = np.repeat(np.arange(len(pick)), sizes)
            e = np.repeat(bounds[pick] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(len(r))
            j, xe = at[e], v[e]
            sums = np.zeros((len(pick), k))
            np.add.at(sums, r, m.factors[j] * xe[:, None])
            squares = np.zeros((len(pick), k))
            np.add.at(squares, r, (m.factors[j] * xe[:, None]) ** 2)
            z = bias[0] + np.bincount(r, m.weights[j] * xe, len(pick)) + 0.5 * (sums**2 - squares).sum(1)
            err = (sigmoid(z) - y[pick]) / len(pick)
            g = [np.asarray([err.sum()]), np.bincount(j, err[r] * xe, d) + decay * m.weights, np.zeros((d, k))]
            np.add.at(g[2], j, (err[r] * xe)[:, None] * (sums[r] - m.factors[j] * xe[:, None]))
            g[2] += decay * m.factors
            step += 1
            for p, (weights, grad) in enumerate(zip((bias, m.weights, m.factors), g, strict=True)):
                first[p] = 0.9 * first[p] + 0.1 * grad
                second[p] = 0.999 * second[p] + 0.001 * grad**2
                weights -= pace * (first[p] / (1 - 0.9**step)) / (np.sqrt(second[p] / (1 - 0.999**step)) + 1e-8)
    m.bias = float(bias[0])
    return m


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_ids(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic of what may be learnt from. Only ids meet in a shuffle."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    return cut(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).join(ids, "doc_id", "left_semi"))


def labelled(docs: DataFrame, known: DataFrame, per_class: int) -> DataFrame:
    """doc_id, toxic, text of the sample. The chosen ids (2 * ``per_class`` at most) go to the texts."""
    some = [known.where(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(cut(some[0].unionByName(some[1])))  # at most 2 * per_class rows of 12 bytes
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.join(chosen, "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A stretch's sums of values and of their squares, and counts, by term and class."""
    for batch in batches:
        toxic = batch.column(0).to_numpy().astype(np.int64)
        data, offsets = utf8(batch.column(1))
        for i, j in chunks(offsets):
            rows, term, x = values(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            key, at = np.unique(term * 2 + toxic[i:j][rows], return_inverse=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key >> 1), pa.array(key & 1), pa.array(np.bincount(at, x)), pa.array(np.bincount(at, x * x)), pa.array(np.bincount(at).astype(np.int64))], names=["term", "toxic", "s", "q", "n"]
            )


def valued(batches: Iterator[pa.RecordBatch], buckets: np.ndarray) -> Iterator[pa.RecordBatch]:
    place = places(buckets)
    for batch in batches:
        ids = batch.column(0).to_numpy()
        data, offsets = utf8(batch.column(1))
        for i, j in chunks(offsets):
            rows, at, x = values(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], place)
            yield pa.RecordBatch.from_arrays([pa.array(ids[i:j][rows]), pa.array(at.astype(np.int32)), pa.array(x)], names=["doc_id", "at", "x"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 4000, most_terms: int = 2048, least_terms: int = 64, least_docs: int = 3, least_t: float = 3.5, **options: float) -> Machine | None:
    """A machine over the terms, each in ``least_docs`` texts of a class, whose class means differ by ``least_t`` standard
    errors: at most ``most_terms``, and the ``least_terms`` best in any case."""
    known = labelled_ids(docs, labels)
    sample = cut(labelled(docs, known, per_class))
    n = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return None
    n_all = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    sums = sample.select("toxic", "text").mapInArrow(summed, "term long, toxic long, s double, q double, n long").groupBy("term").agg(
        *[F.sum(F.when(F.col("toxic") == c, F.col(v))).alias(f"{v}{c}") for v in "sqn" for c in (0, 1)]
    ).na.fill(0)
    mean = [F.col(f"s{c}") / n[c] for c in (0, 1)]
    spread = [F.greatest(F.col(f"q{c}") / n[c] - mean[c] ** 2, F.lit(1e-6)) / n[c] for c in (0, 1)]
    best = sums.where(F.greatest("n0", "n1") >= least_docs).select("term", (F.abs(mean[1] - mean[0]) / F.sqrt(spread[0] + spread[1])).alias("t"))
    best = best.orderBy(F.desc("t"), "term").limit(most_terms).collect()
    buckets = np.asarray(sorted(r["term"] for i, r in enumerate(best) if i < least_terms or r["t"] >= least_t), np.int64)
    order = {r[0]: (i, r[1]) for i, r in enumerate(sample.select("doc_id", "toxic").orderBy("doc_id").collect())}
    got = sample.select("doc_id", "text").mapInArrow(lambda b: valued(b, buckets), "doc_id long, at int, x double").toPandas().sort_values(["doc_id", "at"], kind="stable")
    rows = got["doc_id"].map({k: v[0] for k, v in order.items()}).to_numpy(np.int64)
    y = np.asarray([v[1] for v in order.values()], float)
    machine = train(buckets, rows, got["at"].to_numpy(np.int64), got["x"].to_numpy(float), y, **options)
    machine.bias += float(np.log(n_all[1] * n[0] / (n_all[0] * n[1])))  # the classes' shares before they were sampled
    return machine


def scored(batches: Iterator[pa.RecordBatch], m: Machine | None) -> Iterator[pa.RecordBatch]:
    place = places(m.buckets) if m else None
    for batch in batches:
        score = np.zeros(batch.num_rows)
        data, offsets = utf8(batch.column(1))
        for i, j in chunks(offsets) if m else ():
            score[i:j] = sigmoid(raw_scores(m, *values(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], place), j - i))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])


def score(docs: DataFrame, labels: DataFrame, machine: Machine | None = None, **options: float) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    machine = machine or fit(docs, labels, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(lambda b: trimmed(scored(b, machine)), SCHEMA)
