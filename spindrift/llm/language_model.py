"""Scoring by a bigram language model kept in Elias-Fano tries.

Training documents are those whose crc32(id) modulo 5 is not 1. The model interpolates with an absolute discount:

    P(w | v) = max(c(v, w) - D, 0) / c(v)  +  D * n(v) / c(v) * P(w),        P(w) alone after an unknown v

c(v) counts v, n(v) its distinct followers; D is the share n1 / (n1 + 2 n2), held between 0.5 and 0.95, of all distinct
bigrams that occur once (n1) and twice (n2). P(w) is the unigram discounted by 0.8 of every word of the training texts;
unknown words get what the discount took. The ``top`` most frequent words' codes are sent to all tasks as one table, all
others' counts reach the shards that hold them by a join. Probabilities are quantised to 8 bits, downwards, so they sum
to one at most. Neither ``top`` nor the number of shards changes a score.

The bigrams are split over shards by their first word; a first word so frequent that it would fill a shard is split
further by its second word. A task sends each shard its bigrams once, sorted, with their counts in training and the
documents they occur in. The same rows are read twice: first each shard counts n1, n2, its followers of split words and
names its second words that are not in the table; these counts are summed (n(v) is exact, as a bigram is in one shard)
and handed to the shards. Then the shard's task builds a trie of two levels, byte columns that are read without decoding:
sorted first words, pointers to their followers,
followers relative to the first word (ranks in the shard's list of words, made monotone by the number of the first
word), both sequences in Elias-Fano form, and codes of quantised probabilities. It then asks the trie for every bigram,
a successor search among the followers of its first word, and passes on sums by document. All counts cover all
documents. Words are known by hashes: of 48 bits within a shard, of 64 bits elsewhere.

Tokens: words of the A-Z lower-cased text, then one end. The base score is the add-half unigram of the same counts.

Defined cases: null and empty texts are an end token alone; without training documents every word is unknown; a null
doc_id counts as '' where ids are hashed; repeated rows are scored each; an empty table gives an empty result; other
columns are left out.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut
from spindrift.llm.words import chunks, mix, utf8, word_hashes

DISCOUNT, TOP, SHARD_WORDS, BLOCK_WORDS = 0.8, 1_000_000, 2_500_000, 1_200_000
#: Documents of a block at most, as their places are 16 bits wide; more go to the next block.
BLOCK_DOCS = 60_000
END, START = np.uint64(0x1234567887654321), np.uint64(0x0FEDCBA99ABCDEF0)
U64 = np.uint64


class EliasFano:
    """A monotone sequence of n values below ``universe``: low bits packed, high bits as counts of each bucket (a
    bucket's numbers end where the running count says). ``rank(i, x)`` finds x without decoding."""

    def __init__(self, n: int, bits: int, low: np.ndarray, ends: np.ndarray):
        self.n, self.bits, self.low, self.ends = n, bits, low, ends

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        bits = max(0, (universe // max(n, 1)).bit_length() - 1)
        values = values.astype(U64)
        high = (values >> U64(bits)).astype(np.int64)
        ends = np.searchsorted(high, np.arange((universe >> bits) + 1), side="right").astype(np.uint32)
        low = np.zeros((n * bits + 63) // 64 + 1, U64)
        if bits:
            at = np.arange(n, dtype=U64) * U64(bits)
            part = values & U64((1 << bits) - 1)
            word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + U64(bits) > U64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        return cls(n, bits, low, ends)

    def lows(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        at = i.astype(U64) * U64(self.bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        more = np.where(shift == 0, U64(0), self.low[word + 1] << ((U64(64) - shift) & U64(63)))
        return ((self.low[word] >> shift) | more) & U64((1 << self.bits) - 1)

    def find(self, x: np.ndarray) -> np.ndarray:
        """Place of each x, or -1: the first value not below it, searched within its bucket."""
        if not self.n:
            return np.full(len(x), -1)
        high = (x >> U64(self.bits)).astype(np.int64)
        inside = high < len(self.ends)
        high = np.where(inside, high, 0)
        want = x & U64((1 << self.bits) - 1)
        a = np.where(high > 0, self.ends[np.maximum(high - 1, 0)], 0).astype(np.int64)
        b = stop = self.ends[high].astype(np.int64)
        while (open_ := a < b).any():
            mid = (a + b) // 2
            below = self.lows(np.minimum(mid, self.n - 1)) < want
            a, b = np.where(open_ & below, mid + 1, a), np.where(open_ & ~below, mid, b)
        hit = inside & (a < stop) & (self.lows(np.minimum(a, self.n - 1)) == want)
        return np.where(hit, a, -1)

    def columns(self) -> list[bytes]:
        return [np.asarray([self.n, self.bits], np.int64).tobytes(), self.low.tobytes(), self.ends.tobytes()]

    @classmethod
    def view(cls, head: bytes, low: bytes, ends: bytes) -> EliasFano:
        n, bits = np.frombuffer(head, np.int64)
        return cls(int(n), int(bits), np.frombuffer(low, U64), np.frombuffer(ends, np.uint32))


class Codebook:
    """256 levels, evenly spaced in the logarithm from ``least`` to 1; codes round down."""

    def __init__(self, least: float):
        self.low = float(np.log10(max(least, 1e-300)))
        self.levels = 10.0 ** np.linspace(self.low, 0.0, 256)
        self.levels[0] *= 1 - 1e-9

    def code(self, p: np.ndarray) -> np.ndarray:
        return np.clip(np.searchsorted(self.levels, p, side="right") - 1, 0, 255).astype(np.uint8)


def in_training(doc_ids: list[int | None]) -> np.ndarray:
    return np.asarray([zlib.crc32(b"" if d is None else str(d).encode()) % 5 != 1 for d in doc_ids], bool)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, np.ndarray, np.ndarray, np.ndarray]]:
    """(block, doc ids, first words, second words, documents' places): the bigrams of some million words at a time."""
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ids: list = []
    size, number = 0, 0

    def out():
        v, w, d = (np.concatenate([h[k] for h in held]) for k in range(3))
        held.clear()
        return (part << 24) + number, ids, v, w, d

    for batch in batches:
        data, offsets = utf8(batch.column(1))
        keys = batch.column(0).to_pylist()
        for i, j in ((a, min(a + BLOCK_DOCS, b)) for first, b in chunks(offsets) for a in range(first, b, BLOCK_DOCS)):
            if held and len(ids) + j - i > BLOCK_DOCS:
                yield out()
                ids, size, number = [], 0, number + 1
            words, rows = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            n = j - i
            ends = np.searchsorted(rows, np.arange(1, n + 1), side="left")
            v = np.insert(words, np.concatenate([[0], ends[:-1]]), START)
            w = np.insert(words, ends, END)
            d = np.repeat(np.arange(n, dtype=np.int32), np.bincount(rows, minlength=n) + 1)
            held.append((v, w, d + np.int32(len(ids))))
            ids += keys[i:j]
            size += len(v)
            if size >= BLOCK_WORDS:
                yield out()
                ids, size, number = [], 0, number + 1
    if held:
        yield out()


def counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, ids, _, w, d in blocks(batches):
        word, n = np.unique(w[in_training(ids)[d]], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])


class Plan:
    """What all tasks share: the table of frequent words, the shards, and the first words that are split."""

    def __init__(self, n: int, v: int, words: np.ndarray, counts: np.ndarray, shards: int, largest: int = 0):
        order = np.argsort(words.view(U64))
        self.words, counts = words.view(U64)[order], counts[order]
        self.n, self.v, self.shards = n, v, shards
        rest = DISCOUNT * v / n if n else 1.0
        self.unigram = Codebook(min(rest, (1 - DISCOUNT) / max(n, 1)))
        self.codes, self.other = self.count_codes(counts), int(self.unigram.code(np.asarray([rest]))[0])
        self.whole, self.largest = len(counts) >= v, max(largest, int(counts.max()) if len(counts) else 0)
        hot = counts * 4 * shards > n
        hot_words, hot_counts = self.words[hot], counts[hot]
        if END in hot_words:  # there are as many starts
            hot_words, hot_counts = np.append(hot_words, START), np.append(hot_counts, hot_counts[hot_words == END])
        by = np.argsort(hot_words)
        self.hot, self.hot_counts = hot_words[by], hot_counts[by]
        self.base = np.log10(n + 0.5 * (v + 1))

    def count_codes(self, counts: np.ndarray) -> np.ndarray:
        return self.unigram.code((counts - DISCOUNT) / max(self.n, 1))

    def unigram_codes(self, w: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(w), self.other, np.uint8)
        at = np.minimum(np.searchsorted(self.words, w), len(self.words) - 1)
        return np.where(self.words[at] == w, self.codes[at], self.other).astype(np.uint8)

    def is_hot(self, v: np.ndarray) -> np.ndarray:
        if not len(self.hot):
            return np.zeros(len(v), bool)
        at = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
        return self.hot[at] == v

    def shard(self, v: np.ndarray, w: np.ndarray) -> np.ndarray:
        key = np.where(self.is_hot(v), mix(v + w * U64(5)), v)
        return (mix(key + U64(77)) % U64(self.shards)).astype(np.int32)


def narrowed(x: np.ndarray, size: int) -> bytes:
    """The low ``size`` bytes of each number."""
    return x.view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def widened(data: bytes, size: int) -> np.ndarray:
    out = np.zeros((len(data) // size, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8).reshape(-1, size)
    return out.view(U64)[:, 0]


FIRST_BYTES, SECOND_BYTES = 6, 6
FIRST_MASK, SECOND_MASK = U64((1 << 8 * FIRST_BYTES) - 1), U64((1 << 8 * SECOND_BYTES) - 1)


SENT = "shard int, block long, first binary, followers binary, second binary, counts binary, training binary, codes binary, docs binary, doc_ids binary"
#: Kinds of what shards count: bigrams seen once and twice (words 1 and 2), followers of a split word, words to look up.
SURVEY, SEEN, FOLLOWERS, LOOKUP = "kind int, shard int, word long, n long", 0, 1, 2
PART = "block long, rows binary, words binary, known binary, base binary, score binary, doc_ids binary"


def sent(batches: Iterator[pa.RecordBatch], plan) -> Iterator[pa.RecordBatch]:
    """One row a block and shard: its distinct bigrams, sorted, their counts (in all, in training) and documents."""
    plan = plan.value
    names = [f.split()[0] for f in SENT.split(", ")]
    for block, ids, v, w, d in blocks(batches):
        shard = plan.shard(v, w)
        order = np.lexsort((w & SECOND_MASK, v & FIRST_MASK, shard))
        v, w, d, shard = v[order], w[order], d[order].astype(np.uint16), shard[order]
        at = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))
        counts = np.diff(np.append(at, len(v))).astype(np.uint32)
        training = np.add.reduceat(in_training(ids)[d].astype(np.uint32), at).astype(np.uint32)
        kv, kw, ks = v[at], w[at], shard[at]
        ends = np.append(at, len(d))
        codes = plan.unigram_codes(kw)
        doc_ids = np.asarray([-(2**63) if x is None else x for x in ids], np.int64)
        rows: list[list] = [[] for _ in names]
        starts = np.append(np.flatnonzero(np.concatenate([[True], ks[1:] != ks[:-1]])), len(ks))
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            first = np.concatenate([[True], kv[a + 1 : b] != kv[a : b - 1]])
            places = np.append(np.flatnonzero(first), b - a)
            own = d[ends[a] : ends[b]]
            here = np.unique(own)  # documents are numbered anew within the row
            row = [int(ks[a]), block, narrowed(kv[a:b][first], FIRST_BYTES), np.diff(places).astype(np.uint32).tobytes(), narrowed(kw[a:b], SECOND_BYTES), counts[a:b].tobytes(), training[a:b].tobytes(),
                   codes[a:b].tobytes(), own.tobytes(), np.concatenate([here.astype(np.int64), doc_ids[here]]).tobytes()]
            for x, y in zip(rows, row, strict=True):
                x.append(y)
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 8]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], names=names)


def keys_of(row: dict) -> tuple[np.ndarray, np.ndarray]:
    first, n = widened(row["first"], FIRST_BYTES), np.frombuffer(row["followers"], np.uint32)
    return np.repeat(first, n), widened(row["second"], SECOND_BYTES)


def training_bigrams(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, second word and count of a shard's distinct training bigrams, sorted."""
    v, w, c = [], [], []
    for row in rows:
        n = np.frombuffer(row["training"], np.uint32)
        a, b = keys_of(row)
        v.append(a[n > 0]), w.append(b[n > 0]), c.append(n[n > 0])
    v, w, c = np.concatenate(v), np.concatenate(w), np.concatenate(c).astype(np.int64)
    order = np.lexsort((w, v))
    v, w, c = v[order], w[order], c[order]
    at = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])])) if len(v) else np.zeros(0, np.int64)
    return v[at], w[at], np.add.reduceat(c, at) if len(at) else c


def surveyed(table: pa.Table, plan) -> pa.Table:
    """What this shard adds to the counts that all shards need, and its second words that the plan's table lacks."""
    plan = plan.value
    rows = table.to_pylist()
    v, _, c = training_bigrams(rows)
    split, followers = np.unique(v[np.isin(v, plan.hot & FIRST_MASK)], return_counts=True)
    lookup = np.zeros(0, U64)
    if not plan.whole:
        lookup = np.unique(np.concatenate([np.unique(keys_of(r)[1][np.frombuffer(r["codes"], np.uint8) == plan.other]) for r in rows]))
    kind = np.repeat([SEEN, FOLLOWERS, LOOKUP], [2, len(split), len(lookup)]).astype(np.int32)
    word = np.concatenate([np.asarray([1, 2], U64), split, lookup]).astype(np.int64)
    n = np.concatenate([[(c == 1).sum(), (c == 2).sum()], followers, np.zeros(len(lookup))]).astype(np.int64)
    shard = np.full(len(kind), rows[0]["shard"], np.int32)
    return pa.table([pa.array(x) for x in (kind, shard, word, n)], names=["kind", "shard", "word", "n"])


class Trie:
    """The two levels of one shard, from the training bigrams of all blocks. ``survey`` has n1, n2, the numbers of
    followers of the split words and the largest count of a word; one lone shard counts them itself."""

    def __init__(self, rows: list[dict], hot: np.ndarray, hot_counts: np.ndarray, shards: int, survey: tuple[int, int, np.ndarray, int] | None = None):
        if survey is None and shards > 1:
            raise ValueError("one of several shards needs the counts of all")
        self.hot, self.hot_counts = hot, hot_counts  # words split over all shards, sorted, and their counts in all
        v, w, c = training_bigrams(rows)
        begin = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]])) if len(v) else np.zeros(0, np.int64)
        first, kinds = v[begin], np.diff(np.append(begin, len(v)))
        totals = np.add.reduceat(c, begin) if len(begin) else c
        if survey is None:
            survey = int((c == 1).sum()), int((c == 2).sum()), np.zeros(len(hot), np.int64), int(totals.max(initial=1))
        once, twice, self.hot_kinds, largest = survey
        self.discount = float(np.clip(once / max(1, once + 2 * twice), 0.5, 0.95))
        number = np.repeat(np.arange(len(first)), kinds)
        split = self.hot_count(first)
        kinds = np.where(split > 0, self.hot_count(first, self.hot_kinds), kinds)
        totals = np.where(split > 0, split, totals)
        self.totals, self.spread = totals, self.discount * kinds / np.maximum(totals, 1)
        self.vocabulary, rank = np.unique(w, return_inverse=True)
        p = (c - self.discount) / totals[number] if len(c) else np.zeros(0)
        book = Codebook((1 - self.discount) / max(largest, 1))
        self.levels, self.codes = book.levels, book.code(p)
        self.first = EliasFano.view(*EliasFano.of(first, 1 << 8 * FIRST_BYTES).columns())
        self.second = EliasFano.view(*EliasFano.of(number * max(1, len(self.vocabulary)) + rank, max(1, len(first) * len(self.vocabulary))).columns())

    def hot_count(self, v: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
        """Counts (or other numbers) of the words that are split, 0 for others."""
        counts = self.hot_counts if counts is None else counts
        if not len(self.hot):
            return np.zeros(len(v), np.int64)
        at = np.minimum(np.searchsorted(self.hot, v), len(self.hot) - 1)
        return np.where(self.hot[at] == v, counts[at], 0)

    def ask(self, v: np.ndarray, w: np.ndarray, p1: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each first word, and the interpolated probability of each bigram."""
        split = self.hot_count(v)
        absent = np.where(split > 0, self.discount * self.hot_count(v, self.hot_kinds) / np.maximum(split, 1) * p1, p1)
        if not len(self.totals):
            return split, absent
        at = self.first.find(v)
        known = at >= 0
        total = np.where(known, self.totals[at], split)
        r = np.minimum(np.searchsorted(self.vocabulary, w), len(self.vocabulary) - 1)
        seen = known & (self.vocabulary[r] == w)
        place = np.full(len(v), -1)
        place[seen] = self.second.find((at[seen] * len(self.vocabulary) + r[seen]).astype(U64))
        pair = np.where(place >= 0, self.levels[self.codes[place]], 0.0)
        return total, np.where(known, pair + self.spread[at] * p1, absent)


def scored(table: pa.Table, told: pa.Table, plan) -> pa.Table:
    """Of each block the sums of this shard's bigrams by document. ``told`` is what all shards counted."""
    plan = plan.value
    rows = table.to_pylist()
    kind, known, n = (told.column(k).to_numpy() for k in ("kind", "word", "n"))
    hot = plan.hot & FIRST_MASK
    order = np.argsort(hot)
    hot = hot[order]
    kinds = np.zeros(len(hot), np.int64)
    kinds[np.searchsorted(hot, known[kind == FOLLOWERS].astype(U64))] = n[kind == FOLLOWERS]
    seen = [int(n[(kind == SEEN) & (known == k)].sum()) for k in (1, 2)]
    looked = np.argsort(known[kind == LOOKUP])
    rare, rare_codes = known[kind == LOOKUP][looked].astype(U64), plan.count_codes(n[kind == LOOKUP][looked])
    trie = Trie(rows, hot, plan.hot_counts[order].astype(np.int64), plan.shards, (*seen, kinds, plan.largest)) if rows else None
    out: list[list] = [[] for _ in range(7)]
    for row in rows:
        v, w = keys_of(row)
        codes = np.frombuffer(row["codes"], np.uint8)
        if len(rare):
            at = np.minimum(np.searchsorted(rare, w), len(rare) - 1)
            codes = np.where((codes == plan.other) & (rare[at] == w), rare_codes[at], codes)
        total, p = trie.ask(v, w, plan.unigram.levels[codes])
        word = v != (START & FIRST_MASK)
        here, ids = np.frombuffer(row["doc_ids"], np.int64).reshape(2, -1)
        d = np.searchsorted(here, np.frombuffer(row["docs"], np.uint16))
        key = np.repeat(np.arange(len(v)), np.frombuffer(row["counts"], np.uint32))
        sums = [np.bincount(d, weights=x[key], minlength=len(here)) for x in (word, word & (total > 0), np.where(word, np.log10(total + 0.5), 0.0), np.log10(np.minimum(p, 1.0)))]
        values = [row["block"], here.astype(np.uint16).tobytes(), sums[0].astype(np.uint32).tobytes(), sums[1].astype(np.uint32).tobytes(), sums[2].tobytes(), sums[3].tobytes(), ids.tobytes()]
        for x, y in zip(out, values, strict=True):
            x.append(y)
    kinds = [pa.int64(), *[pa.binary()] * 6]
    return pa.table([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=[f.split()[0] for f in PART.split(", ")])


def summed(table: pa.Table) -> pa.Table:
    """A block's documents from its shards' sums."""
    parts = table.to_pylist()
    rows = np.concatenate([np.frombuffer(p["rows"], np.uint16) for p in parts]).astype(np.int64)
    size = int(rows.max()) + 1
    total = lambda k, t: np.bincount(rows, weights=np.concatenate([np.frombuffer(p[k], t) for p in parts]), minlength=size)
    ids = np.zeros(size, np.int64)
    ids[rows] = np.concatenate([np.frombuffer(p["doc_ids"], np.int64) for p in parts])
    there = np.bincount(rows, minlength=size) > 0
    cols = [pa.array(ids[there]), *[pa.array(total(k, t)[there].astype(kind)) for k, t, kind in (("words", np.uint32, np.int64), ("known", np.uint32, np.int64), ("base", np.float64, float), ("score", np.float64, float))]]
    return pa.table(cols, names=["doc_id", "words", "known", "base", "score"])


def score(docs: DataFrame, top: int = TOP) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = cut(texts.mapInArrow(counted_words, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    n, v, largest = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    # the least count that at most ``top`` words reach; there are far fewer counts than words
    least, reached = None, 0
    for r in words.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        if reached + r["count"] > top:
            break
        least, reached = r["n"], reached + r["count"]
    frequent = words.where(F.col("n") >= least).toArrow() if least else pa.table({"word": pa.array([], pa.int64()), "n": pa.array([], pa.int64())})
    ends = words.where(F.col("word") == int(END.view(np.int64))).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-int(n) // SHARD_WORDS))
    plan = Plan(int(n), int(v), frequent["word"].to_numpy().copy(), frequent["n"].to_numpy().copy(), shards, int(largest))
    base, end_known = plan.base, ends > 0
    shared = spark.sparkContext.broadcast(plan)
    bigrams = texts.mapInArrow(lambda it: sent(it, shared), SENT)
    survey = bigrams.groupBy("shard").applyInArrow(lambda t: surveyed(t, shared), SURVEY)
    if not plan.whole:
        others = words.where(F.col("n") < least) if least else words
        survey = survey.unionByName(others.select(F.lit(LOOKUP).alias("kind"), F.lit(None).cast("int").alias("shard"), F.col("word").bitwiseAND(int(SECOND_MASK)).alias("word"), "n"))
    summed_up = survey.groupBy("kind", "word").agg(F.sum("n").alias("n"), F.collect_list("shard").alias("own")).where((F.col("kind") != LOOKUP) | (F.col("n") > 0))
    every = F.sequence(F.lit(0), F.lit(shards - 1))
    told = summed_up.select("kind", "word", "n", F.explode(F.when(F.col("kind") == LOOKUP, F.col("own")).otherwise(every)).alias("shard"))
    # both readers of the bigrams share one exchange
    parts = bigrams.groupBy("shard").cogroup(told.groupBy("shard")).applyInArrow(lambda t, k: scored(t, k, shared), PART)
    rows = parts.groupBy("block").applyInArrow(summed, "doc_id long, words long, known long, base double, score double")
    doc_id = F.when(F.col("doc_id") != -(2**63), F.col("doc_id"))
    tokens = F.col("words") + 1
    return rows.select(
        doc_id.alias("doc_id"),
        (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1).alias("held_out"),
        tokens.alias("n_tokens"), (F.col("known") + int(end_known)).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.lit(float(np.log10(ends + 0.5))) - tokens * F.lit(float(base))).alias("base_score"), "score",
    )
