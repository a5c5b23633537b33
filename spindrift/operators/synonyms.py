"""Word vectors fitted to a corpus, kept on disk, and the words nearest to given ones.

Skip-grams with negative samples, trained by shares: texts are dealt into shares of about four million words, each task trains on
one share and holds the vectors of that share's words alone, and a word's vectors are averaged over the shares that have it.
Vocabulary and vectors are tables from end to end; nothing of them passes through the driver, and a task's memory does not
grow with the vocabulary. Shares follow from the texts and a share is put into one order before it trains: two runs give the
same vectors, up to the last digits where shares are several.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spindrift.operators import lift
from spindrift.sources.session import fixed

#: Words that one task trains on.
SHARE = 4_000_000
#: Stands between the words of a text.
GAP = "\x00"
#: Words of a block at most, negative samples a pair of words, those drawn for a block (they stand for all), and the length of a step.
BLOCK, NEGATIVES, DRAWN, RATE = 1024, 5, 128, 0.05


def shares(rows: DataFrame, tokens: str, share: int = SHARE) -> int:
    """Tasks among which the words of an array column are of about ``share`` each."""
    words = rows.agg(F.sum(F.size(tokens).cast("long"))).first()[0] or 0
    return max(1, -(-words // share))


def beginnings(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Small random vectors that follow from word and seed, so that all shares begin alike."""
    x = pd.util.hash_array(words.astype(object))[:, None] + np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):  # the mixing of splitmix64
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return (((x ^ (x >> np.uint64(31))) >> np.uint64(40)).astype(np.float32) / (1 << 24) - 0.5) / size


def move(table: np.ndarray, squares: np.ndarray, ids: np.ndarray, slopes: np.ndarray) -> None:
    """One step along the summed slopes of each row, divided by the root of the row's squared slopes so far (Adagrad)."""
    order = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.diff(ids[order], prepend=-1))
    rows, g = ids[order[first]], np.add.reduceat(slopes[order], first)
    squares[rows] += np.einsum("ij,ij->i", g, g) / g.shape[1]
    table[rows] += RATE * g / np.sqrt(squares[rows] + 1e-10)[:, None]


def miss(products: np.ndarray) -> np.ndarray:
    """1 - sigmoid, in place."""
    np.exp(products, out=products)
    products += 1
    return np.reciprocal(products, out=products)


def train(ids: np.ndarray, doc: np.ndarray, u: np.ndarray, v: np.ndarray, window: int, rng: np.random.Generator) -> None:
    """Trains u (of words) and v (of words as neighbours) on one pass over the words ``ids`` of the texts ``doc``, block by
    block. A word's window is drawn, as in word2vec, and ends with its text. Products are taken of stretches of a block with
    all words within reach of them, and pairs out of reach count nothing."""
    n, size, stretch = len(ids), u.shape[1], max(64, 2 * window)
    block = stretch * int(np.clip(n // (64 * stretch), 1, BLOCK // stretch))
    odds = np.cumsum(np.bincount(ids, minlength=len(u)) ** 0.75)
    fill = -n % stretch
    reach = rng.integers(1, window + 1, n + fill, dtype=np.int16)
    at, text = (np.pad(x, (window, window + fill), constant_values=c) for x, c in ((ids, 0), (doc, -1)))
    apart = np.abs(np.arange(stretch)[:, None] + window - np.arange(stretch + 2 * window))
    apart[apart == 0] = window + 1  # a word is not its own neighbour
    squares_u, squares_v = np.zeros(len(u), np.float32), np.zeros(len(v), np.float32)
    for k in range(0, n, block):
        m = min(block, n + fill - k)
        near = at[k : k + m + 2 * window]
        own = near[window : window + m]
        reached = lambda x: np.lib.stride_tricks.sliding_window_view(x, stretch + 2 * window, 0)[::stretch]
        texts = reached(text[k : k + m + 2 * window])
        centre = texts[:, window : window + stretch, None]
        on = (apart <= reach[k : k + m].reshape(-1, stretch, 1)) & (texts[:, None, :] == centre) & (centre >= 0)
        x, y = u[own].reshape(-1, stretch, size), v[near]
        z = reached(y)  # stretches x size x words
        g = miss(x @ z)
        g *= on
        dx = (g @ z.transpose(0, 2, 1)).reshape(m, size)
        back = g.transpose(0, 2, 1) @ x
        dy = np.zeros((len(back) + 1, stretch, size), np.float32)
        dy[:-1] += back[:, :stretch]
        dy[1:, : 2 * window] += back[:, stretch:]
        x, others = x.reshape(m, size), np.searchsorted(odds, rng.random(DRAWN) * odds[-1], side="right")
        z = v[others]
        g = miss(x @ -z.T)
        g *= on.sum(2, dtype=np.float32).reshape(m, 1) * np.float32(NEGATIVES / DRAWN)
        move(u, squares_u, own, dx - g @ z)
        move(v, squares_v, np.concatenate([near, others]), np.concatenate([dy.reshape(-1, size)[: len(near)], -(g.T @ x)]))


def lists(x: np.ndarray) -> pa.Array:
    return pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float32()))


def trained(texts: pa.Table, words: pa.Table, size: int, window: int, seeds: list[int]) -> pa.Table:
    """(word, vector, beside) of the words of one share after one pass over its texts; beside is the vector as a neighbour."""
    texts, words = texts.sort_by("text")["text"].combine_chunks(), words.sort_by("word")
    split, known = pc.split_pattern(texts, GAP), words["word"].combine_chunks()
    ids = pc.index_in(pc.list_flatten(split), value_set=known)
    doc = pc.filter(pc.list_parent_indices(split), ids.is_valid()).cast(pa.int32()).to_numpy()
    if "vector" in words.column_names:
        u, v = (pc.list_flatten(words[c]).to_numpy().reshape(-1, size).copy() for c in ("vector", "beside"))
    else:
        u = beginnings(known.to_numpy(zero_copy_only=False), size, seeds[0])
        v = np.zeros_like(u)
    with np.errstate(over="ignore"):  # of exp: the odds are 0 then
        train(ids.drop_null().to_numpy(), doc, u, v, window, np.random.default_rng(seeds))
    return pa.table({"word": known, "vector": lists(u), "beside": lists(v)})


def dealt(rows: DataFrame, tokens: str, parts: int) -> DataFrame:
    """(share, text) of texts of two words at least, by a hash of the text and the number of its copy, so that many copies do
    not meet in one share."""
    texts = rows.groupBy(F.array_join(tokens, GAP).alias("text")).agg(F.count("*").alias("n"))
    each = F.sequence(F.lit(1).cast("long"), F.when(F.contains("text", F.lit(GAP)), F.col("n")))  # a filter would cut texts twice
    copies = texts.select("text", F.explode(each).alias("copy"))
    return copies.select(F.pmod(F.xxhash64("text", "copy"), F.lit(parts)).cast("int").alias("share"), "text").repartition("share")


def vocabulary(texts: DataFrame, least: int) -> DataFrame:
    """(share, word) of the words that occur ``least`` times in all shares together."""
    seen = texts.select("share", F.explode(F.split("text", GAP)).alias("word")).groupBy("share", "word").agg(F.count("*").alias("n"))
    return seen.withColumn("n", F.sum("n").over(Window.partitionBy("word"))).where(F.col("n") >= least).select("share", "word")


@dataclass(frozen=True)
class Word2Vec:
    """Takes the parameters of Spark's estimator of this name, whose driver holds all words and their vectors."""

    vectorSize: int
    windowSize: int
    minCount: int
    numPartitions: int
    maxIter: int
    seed: int
    inputCol: str

    def fit(self, rows: DataFrame) -> DataFrame:
        texts = dealt(rows, self.inputCol, self.numPartitions)
        words = vocabulary(texts, self.minCount)
        if self.maxIter > 1:
            texts, words = fixed(texts), fixed(words)
        for step in range(self.maxIter):
            kept = ["vector", "beside"] if step < self.maxIter - 1 else ["vector"]
            found = self.one_pass(texts, words.join(state, "word") if step else words, step, kept)
            mean = [F.array(*[(F.sum(F.col(c)[i]) / F.count("*")).cast("float") for i in range(self.vectorSize)]).alias(c) for c in kept]
            state = fixed(found.repartition("word").groupBy("word").agg(*mean))
        return state

    def one_pass(self, texts: DataFrame, words: DataFrame, step: int, kept: list[str]) -> DataFrame:
        """(word, vector, beside), what is kept of it, of the words of each share."""

        def share(key: tuple[pa.Scalar, ...], texts: pa.Table, words: pa.Table) -> pa.Table:
            return trained(texts, words, self.vectorSize, self.windowSize, [self.seed, step, key[0].as_py()]).select(["word", *kept])

        schema = ", ".join(["word string", *(f"{c} array<float>" for c in kept)])
        return texts.groupBy("share").cogroup(words.groupBy("share")).applyInArrow(share, schema)


def fit(df: DataFrame, tokens: str, size: int = 50, window: int = 5, least: int = 5, parts: int | None = None, steps: int = 1, seed: int = 1) -> DataFrame:
    """(word, vector) of the words of an array column that occur ``least`` times, trained in ``parts`` shares (None: one for each
    ``SHARE`` words), ``steps`` times."""
    rows = df.select(tokens)
    parts = shares(rows, tokens) if parts is None else parts
    return Word2Vec(vectorSize=size, windowSize=window, minCount=least, numPartitions=parts, maxIter=steps, seed=seed, inputCol=tokens).fit(rows)


def save(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def load(path: str) -> DataFrame:
    return SparkSession.getActiveSession().read.parquet(path)


def vectors(model: DataFrame) -> DataFrame:
    """(word, vector: array<double>)"""
    return model.select("word", F.col("vector").cast("array<double>").alias("vector"))


def synonyms(model: DataFrame, words: list[str], n: int) -> DataFrame:
    """(word, score, n_queries) of the n words nearest to all the given ones together, without these."""
    table = vectors(model)
    asked = table.where(F.col("word").isin(words))
    return lift.related(table, asked, n + len(words)).where(~F.col("word").isin(words)).orderBy(F.desc("score"), "word").limit(n)
