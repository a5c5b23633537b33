"""Benchmark decontamination by pigeonhole edit matching over words.

An item of n words may occur in a document with up to k = n * percent // 100 edited (changed, added or dropped) words.
Cut into k + 1 pieces, at least one piece then occurs unchanged: the rolling hashes of a document's words are looked up
among the pieces (one pass for each piece length, of which there are few). Each hit is verified around its place by
Myers' bit-parallel edit distance, with a bit for each word of the item.

Words are runs of letters and digits of the lower-cased text, so case, punctuation and white space don't count.
The items are a stated query set: blocks of at most BLOCK_BYTES of text go to the executors with the scan of the
documents, which are never shuffled; more items take more scans.

Defined cases: null or wordless items and documents match nothing; items of under SHORT words must occur unchanged;
equal items each report; rows repeated in documents report for each row; a null doc_id or item_id is kept as null;
empty tables give an empty result; other columns are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import fresh
from spindrift.llm.words import chunks, mix, trimmed, utf8, word_hashes

PERCENT, SHORT, BLOCK_BYTES = 20, 8, 16_000_000
SCHEMA = "doc_id long, item_id long, distance long, item_words long, first_word long, end_word long"
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
KEY = 0xD6E8FEB86659FD93


def hashes(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Word hashes and rows, by chunk of rows (i, j)."""
    data, offsets = utf8(pc.utf8_lower(column))
    for i, j in chunks(offsets):
        yield (i, j, *word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], IN_WORD))


def budget(n: int, percent: int = PERCENT) -> int:
    return 0 if n < SHORT else max(1, n * percent // 100)


def pieces(n: int, k: int) -> list[tuple[int, int]]:
    """k + 1 spans (start, length) that make up n words, as even as can be."""
    cuts = [n * i // (k + 1) for i in range(k + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def rolled(words: np.ndarray, size: int) -> np.ndarray:
    h = np.zeros(max(0, len(words) - size + 1), np.uint64)
    for k in range(size):
        h += words[k : k + len(h)] * np.uint64(pow(KEY, k + 1, 2**64))
    return mix(h)


def myers(masks: dict[int, int], m: int, text: list[int], most: int) -> tuple[int, int]:
    """Least edit distance of a pattern of m words to any stretch of ``text`` and that stretch's (first) end; the bit
    vectors are Python integers, so a pattern may have any length. (most + 1, -1) if none is within ``most``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    best, end = most + 1, -1
    for j, w in enumerate(text):
        eq = masks.get(w, 0)
        x = eq | down
        h = (((eq & up) + up) ^ up) | eq
        plus, minus = down | (full & ~(h | up)), up & h
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(x | plus)), plus & x
        if score < best:
            best, end = score, j + 1
    return best, end


class Items:
    """The pieces of a block of items by length, and the bit masks of each item forwards and backwards."""

    def __init__(self, ids: list[int], texts: list[str], percent: int):
        self.ids, self.n, self.k, self.masks, self.back = ids, [], [], [], []
        by: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for i, j, words, rows in hashes(pa.array(texts, pa.string())):
            ends = np.searchsorted(rows, np.arange(j - i + 1))
            for r in range(j - i):
                own = words[ends[r] : ends[r + 1]]
                n, at = len(own), len(self.n)
                k = budget(n, percent)
                self.n.append(n)
                self.k.append(k)
                forward: dict[int, int] = defaultdict(int)
                backward: dict[int, int] = defaultdict(int)
                for p, w in enumerate(own.tolist()):
                    forward[w] |= 1 << p
                    backward[w] |= 1 << (n - 1 - p)
                self.masks.append(dict(forward))
                self.back.append(dict(backward))
                for start, size in pieces(n, k) if n else ():
                    by[size][int(rolled(own[start : start + size], size)[0])].append((at, start))
        self.by = {size: dict(found) for size, found in by.items()}
        self.sieve = {}
        for size, found in self.by.items():
            sieve = np.zeros(1 << 20, bool)
            sieve[np.fromiter(found, np.uint64) & np.uint64((1 << 20) - 1)] = True
            self.sieve[size] = sieve

    def matches(self, words: np.ndarray, rows: np.ndarray, n_rows: int) -> dict[tuple[int, int], tuple[int, int, int]]:
        """Best (distance, first word, end word) of each (row, item)."""
        ends = np.searchsorted(rows, np.arange(n_rows + 1))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        done: set[tuple[int, int, int]] = set()
        for size, found in self.by.items():
            h = rolled(words, size)
            at = np.flatnonzero(self.sieve[size][(h & np.uint64((1 << 20) - 1)).astype(np.int64)])
            at = at[rows[at] == rows[at + size - 1]]
            for p, key in zip(at.tolist(), h[at].tolist(), strict=True):
                for item, start in found.get(key, ()):
                    r = int(rows[p])
                    if (r, item, p - start) in done:
                        continue
                    done.add((r, item, p - start))
                    n, k = self.n[item], self.k[item]
                    a, b = max(int(ends[r]), p - start - k), min(int(ends[r + 1]), p - start + n + k)
                    text = words[a:b].tolist()
                    distance, end = myers(self.masks[item], n, text, k)
                    if distance <= k:
                        _, length = myers(self.back[item], n, text[:end][::-1], k)
                        first = a + end - length - int(ends[r])
                        best[r, item] = min(best.get((r, item), (k + 1, 0, 0)), (distance, first, a + end - int(ends[r])))
        return best


def scanned(batches: Iterator[pa.RecordBatch], items: tuple[list[int], list[str], int]) -> Iterator[pa.RecordBatch]:
    known = Items(*items)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    for batch in batches:
        ids, rows = batch.column(0).to_pylist(), []
        for i, j, words, at in hashes(batch.column(1)):
            for (r, item), (distance, first, end) in sorted(known.matches(words, at, j - i).items()):
                rows.append((ids[i + r], known.ids[item], distance, known.n[item], first, end))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)


def find_leaks(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, distance, item_words, first_word, end_word (the best
    place, counted in the document's words)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES) or 1
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()
        block = ([r[0] for r in part], [r[1] for r in part], percent)
        found = texts.mapInArrow(lambda it, block=block: trimmed(scanned(it, block)), SCHEMA)
        out = found if out is None else out.unionByName(found)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The documents in which no item was found, with the input's columns. Rows of a null doc_id have no name to be
    taken out by and are decided by their text."""
    found = find_leaks(docs.withColumn("doc_id", F.xxhash64(F.col("doc_id").cast("long"), "text")), benchmark, percent)
    name = fresh(docs.columns, "leak")
    return docs.join(found.select(F.col("doc_id").alias(name)).distinct(), F.xxhash64(F.col("doc_id").cast("long"), "text") == F.col(name), "left_anti")
