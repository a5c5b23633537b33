"""Runs of periodically repeated words, by uniting suffix classes in the order of falling common prefixes.

A run is a stretch of words with smallest period q that no neighbouring word extends, of at least ``least`` words and
``times`` periods. For each text:

1. Words become numbers (exact, by a dictionary of the text). Stretches of places whose five-word sequence recurs in the
   text are kept where the nearest recurrence is near enough for a run to fit into the stretch; all runs lie in these.
2. Prefix doubling over the stretches gives the order of their suffixes, and its levels the common prefixes (LCP) of
   neighbours in that order.
3. Kruskal by falling LCP: neighbours' classes are united, the smaller into the larger, each an ordered list of places.
   Two places i < j that become adjacent at LCP l with (times - 1) * (j - i) <= l are a seed. A run's first place and the
   one a period later are always such a pair: a place between them in the class would give the stretch a smaller
   period. So the run of a seed whose preceding words differ is ``[i, j + l)`` with period j - i, and there is no other.

Everything happens where a text is read; nothing is shuffled. A stretch of texts is worked on at a time, a text always
as a whole, so memory follows the longest text.

Defined cases: a null or empty text and one of white space only have no word, no run and the empty collapsed text; a
null doc_id stays null (and ``rewritten`` leaves its text alone); repeated rows give repeated rows; an empty table gives
an empty result; other columns are left out.
"""

from __future__ import annotations

import itertools
import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.words import mix, trimmed

#: Words worked on at a time; a longer single text is still taken whole.
CHUNK_WORDS = 200_000
GRAM = 5
FOUND = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def rewritten(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the texts, chosen by their ids' checksum, with a tail that repeats a part of itself."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def stretches(ids: np.ndarray, docs: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of words in which runs can lie. ``ids`` number each text's words; texts follow
    one another and ``docs`` numbers them."""
    n = len(ids) - GRAM + 1
    if n < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = docs[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(GRAM):
        grams = mix(grams + ids[k : k + n].astype(np.uint64) * np.uint64(2 * k + 3))
    whole = np.flatnonzero(docs[:n] == docs[GRAM - 1 :])
    order = whole[np.argsort(grams[whole], kind="stable")]  # of equal grams, in order of text
    same = grams[order[1:]] == grams[order[:-1]]
    gap = np.full(len(ids) + 1, np.iinfo(np.int64).max)  # to the next equal gram
    gap[order[:-1][same]] = np.diff(order)[same]
    recurs = np.zeros(len(ids) + 1, bool)
    recurs[order[:-1][same]] = True
    recurs[order[1:][same]] = True
    inside = np.zeros(len(recurs), bool)
    inside[1:-1] = recurs[1:-1] & recurs[:-2] & (docs[1:] == docs[:-1])
    starts = np.flatnonzero(recurs & ~inside)
    if not len(starts):
        return starts, starts
    ends = np.flatnonzero(recurs & ~np.concatenate([inside[1:], [False]])) + 1
    nearest = np.minimum.reduceat(gap, starts)  # what lies between two stretches has no gap
    good = (times - 1) * nearest <= ends - starts + GRAM - 1
    return starts[good], ends[good] + GRAM - 1


def neighbours(ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in the order of the stretches' suffixes with their LCP (of one stretch, GRAM words or more):
    place, other place, LCP; and for each place in the packed stretches its stretch and its place in ``ids``."""
    sizes = ends - starts
    owner = np.repeat(np.arange(len(starts)), sizes + 1)
    first = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1]
    at = np.arange(len(owner)) - first[owner] + starts[owner]
    bound = np.zeros(len(owner), bool)  # a stretch is followed by a bound that equals nothing
    bound[first + sizes] = True
    word = ids[np.minimum(at, len(ids) - 1)].astype(np.int64)
    top = int(word.max(initial=0)) + 1
    key = np.where(bound, top * len(starts) + owner, owner * top + word)
    rank = np.unique(key, return_inverse=True)[1].astype(np.int64)
    levels, h, n = [rank], 1, len(rank)
    while rank.max() + 1 < n:
        after = rank[np.minimum(np.arange(n) + h, n - 1)]
        rank = np.unique(rank * (n + 1) + after, return_inverse=True)[1].astype(np.int64)
        levels.append(rank)
        h *= 2
    order = np.argsort(rank)
    i, j = order[:-1], order[1:]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        same = levels[k][np.minimum(i + lcp, n - 1)] == levels[k][np.minimum(j + lcp, n - 1)]
        lcp += same << k
    good = (lcp >= GRAM) & (owner[i] == owner[j])
    return i[good], j[good], lcp[good], owner, at


def seeds(i: np.ndarray, j: np.ndarray, lcp: np.ndarray, times: int) -> list[tuple[int, int, int]]:
    """(place, distance, LCP) of places that become adjacent in their class at an LCP of (times - 1) distances or more."""
    order = np.argsort(-lcp, kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    found, share = [], times - 1
    for a, b, most in zip(i[order].tolist(), j[order].tolist(), lcp[order].tolist(), strict=True):
        while (up := parent.setdefault(a, a)) != a:
            parent[a] = a = parent[up]
        while (up := parent.setdefault(b, b)) != b:
            parent[b] = b = parent[up]
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small, a, b = small, large, b, a
        parent[b] = a
        members[a] = large
        if len(small) == 1:
            x = small[0]
            k = bisect_left(large, x)
            if k and share * (x - large[k - 1]) <= most:
                found.append((large[k - 1], x - large[k - 1], most))
            if k < len(large) and share * (large[k] - x) <= most:
                found.append((x, large[k] - x, most))
            large.insert(k, x)
            continue
        own = set(small)
        if 8 * len(small) < len(large):
            for x in small:
                large.insert(bisect_left(large, x), x)
        else:
            large += small
            large.sort()  # two ordered parts: one merge
        for x in small:
            k = bisect_left(large, x)
            for y in large[max(k - 1, 0) : k] + large[k + 1 : k + 2]:
                if y not in own and share * abs(x - y) <= most:
                    found.append((min(x, y), abs(x - y), most))
    return found


def runs_of(ids: np.ndarray, docs: np.ndarray, least: int = 6, times: int = 4) -> np.ndarray:
    """Rows (start, length, period) of all runs, by start and period; starts count over all texts' words."""
    starts, ends = stretches(ids, docs, times)
    if not len(starts):
        return np.zeros((0, 3), np.int64)
    i, j, lcp, _, at = neighbours(ids, starts, ends)
    got = np.asarray(seeds(i, j, lcp, times), np.int64).reshape(-1, 3)
    start, period = at[got[:, 0]], got[:, 1]
    before = np.maximum(start - 1, 0)
    extends = (start > 0) & (docs[before] == docs[start]) & (ids[before] == ids[before + period])
    good = ~extends & (period + got[:, 2] >= least)
    rows = np.stack([start, period + got[:, 2], period], axis=1)[good]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def searched(batches: Iterator[pa.RecordBatch], least: int, times: int, rewrite: Callable | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys, column = batch.column(0).to_pylist(), batch.column(1)
        r = 0
        while r < len(keys):
            first, words, ids, ends = r, [], [], []
            while r < len(keys) and (r == first or len(words) < CHUNK_WORDS):
                own = (column[r].as_py() or "").encode().split()  # bytes split at 0x20 and 0x09-0x0D
                own = rewrite(keys[r], own) if rewrite else own
                number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
                words += own
                ids += map(number.__getitem__, own)
                ends.append(len(words))
                r += 1
            yield collapsed(batch.column(0).slice(first, r - first), words, np.asarray(ids, np.int64), np.asarray(ends, np.int64), least, times)


def collapsed(keys: pa.Array, words: list[bytes], ids: np.ndarray, ends: np.ndarray, least: int, times: int) -> pa.RecordBatch:
    begins = np.concatenate([[0], ends[:-1]])
    docs = np.repeat(np.arange(len(ends)), ends - begins)
    runs = runs_of(ids, docs, least, times)
    owner = docs[runs[:, 0]]
    drop = np.zeros(len(words) + 1, np.int32)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    gone = np.cumsum(drop)[: len(words)] > 0
    texts, hit = [], np.zeros(len(ends), bool)
    hit[owner] = True
    for r in range(len(ends)):
        own = words[begins[r] : ends[r]]
        texts.append(b" ".join(itertools.compress(own, ~gone[begins[r] : ends[r]]) if hit[r] else own).decode())
    bounds = np.searchsorted(owner, np.arange(len(ends) + 1))
    rows = pa.StructArray.from_arrays([pa.array(runs[:, 0] - begins[owner]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUN))
    return pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), rows), pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = 6, times: int = 4, rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, runs (start, length, period in words, by start and period) and collapsed: the text's words without those
    that any run repeats after its first period, joined by single spaces. ``rewrite`` changes a text's words first.
    ``least`` must be 6 or more and ``times`` 4 or more: a run's two ends then lie in one stretch of recurring five-word
    sequences."""
    if least < GRAM + 1 or times < 4:
        raise ValueError("runs of fewer than 6 words or 4 periods are not looked for")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(lambda b: trimmed(searched(b, least, times, rewrite)), FOUND)


def run_digests(docs: DataFrame, rewrite: Callable | None = rewritten) -> DataFrame:
    """A row per document: the number of runs, the longest one, and digests of the runs and of the collapsed text."""
    found = periodic_runs(docs, rewrite=rewrite)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return found.withColumn("best", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("1000 * best.length div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
