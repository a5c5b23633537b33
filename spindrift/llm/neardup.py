"""Near-duplicate groups by SuperMinHash signatures, banding, exact verification and connected components.

1. One pass over the texts gives each document its number of distinct five-word shingles, a 128-bit digest of that
   set, and hashes of the bands of its SuperMinHash signature (Ertl 2017). Equal sets become one class.
2. Classes that share a band meet in a bucket. A bucket's members are not paired with each other: each is compared
   with the bucket's hub, the member that shares most bands with others (as a rule the text that the copies were made
   from). This joins almost all groups.
3. Where the members met through one hub are still of several components, those outside the largest one are compared with
   all others, in blocks of bounded size: a task gets two blocks, counts the intersections of their sets by joining the sorted shingles in numpy, and passes
   on only the links that join components. So no pair that shares a band is left out, and no pair becomes a row.
4. A compared pair is linked if 100 * intersection >= percent * union of the full shingle sets.

The number of bands of 4 rows follows the threshold: a pair that just passes shares no band with probability 7.5e-6 at
most (16 bands at 0.85, 23 at 0.80).

Defined cases: without a word (or text) a document has no shingle and is linked with nothing; with fewer than five
words its whole sequence is its only shingle; a null doc_id is never linked (component null, kept); rows of one
doc_id are one node; an empty table gives an empty result; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import components, cut, fresh
from spindrift.llm.words import chunks, mix, shingles, trimmed, utf8, word_hashes

BANDS, ROWS = 16, 4
#: Members in a block, and shingles that two blocks' intersections are counted over at a time.
BLOCK, CROSSED = 256, 1_000_000
SIZE = BANDS * ROWS
SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
GOLDEN = 0x9E3779B97F4A7C15


def bands_for(percent: int) -> int:
    """The least number of bands with which a pair of this similarity is missed with probability 7.5e-6 at most."""
    return max(1, math.ceil(math.log(7.5e-6) / math.log1p(-min(percent / 100, 0.999) ** ROWS)))


def super_minhash(hashes: np.ndarray, rows: np.ndarray, n_rows: int, size: int = SIZE) -> np.ndarray:
    """(n_rows, size) signatures of sets given as distinct element hashes. Step j of an element puts the rank j + r at
    the j-th place of its own permutation; a row stops once every place holds a rank below j (no later one can win)."""
    sig = np.full(n_rows * size, np.inf)
    live = np.arange(len(hashes))
    perm: np.ndarray | None = None
    for j in range(size):
        seed = mix(hashes[live] + np.uint64((j + 1) * GOLDEN % 2**64))
        r = (seed >> np.uint64(11)).astype(np.float64) * 2.0**-53
        k = j + (mix(seed) % np.uint64(size - j)).astype(np.int64)
        if perm is None:
            place = k
        else:
            at = np.arange(len(live))
            place = perm[at, k].astype(np.int64)
            perm[at, k] = perm[at, j]
            perm[at, j] = place
        np.minimum.at(sig, rows[live] * size + place, j + r)
        going = sig.reshape(n_rows, size).max(axis=1, initial=0) > j + 1
        stay = going[rows[live]]
        if not stay.any():
            break
        if perm is None:
            first = k[stay]
            live = live[stay]
            perm = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(live), 1))
            at = np.arange(len(live))
            perm[at, first] = 0
            perm[at, 0] = first
        else:
            live, perm = live[stay], perm[stay]
    return sig.reshape(n_rows, size)


def signed(batches: Iterator[pa.RecordBatch], n_bands: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        for i, j in chunks(offsets):
            n = j - i
            words, at = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            h, rows = shingles(words, at, n)
            sizes = np.bincount(rows, minlength=n)
            sums = []
            for salt in (0x2545F4914F6CDD1D, 0x5851F42D4C957F2D):
                total = np.zeros(len(h) + 1, np.uint64)
                np.cumsum(mix(h ^ np.uint64(salt)), out=total[1:])
                ends = np.concatenate([[0], np.cumsum(sizes)])
                sums.append((total[ends[1:]] - total[ends[:-1]]).view(np.int64))
            sig = super_minhash(h, rows, n, n_bands * ROWS).view(np.uint64).reshape(n, n_bands, ROWS)
            keys = np.broadcast_to(np.arange(1, n_bands + 1, dtype=np.uint64) * np.uint64(GOLDEN), (n, n_bands)).copy()
            for r in range(ROWS):
                keys = mix(keys + sig[:, :, r] * np.uint64(2 * r + 3))
            bands = pa.ListArray.from_arrays(pa.array(np.arange(0, n * n_bands + 1, n_bands), pa.int32()), pa.array(keys.reshape(-1).view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, n), pa.array(sizes), pa.array(sums[0]), pa.array(sums[1]), bands], names=["doc_id", "n_shingles", "d1", "d2", "bands"])


def verified(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Rows (a, b) of pairs with texts that pass. A text that many pairs share is read once a batch."""
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        good = np.zeros(len(a), bool)
        data, offsets = utf8(batch.column(2))
        other, other_offsets = utf8(batch.column(3))
        hub: tuple[tuple[int, int], np.ndarray] | None = None
        for i, j in chunks(offsets):
            words, at = word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            h, rows = shingles(words, at, j - i)
            ends = np.searchsorted(rows, np.arange(j - i + 1))
            for r in range(i, j):
                span = slice(other_offsets[r], other_offsets[r + 1])
                key = (b[r], span.stop - span.start)
                if hub is None or hub[0] != key:
                    own = other[span]
                    hub = key, shingles(*word_hashes(own, np.asarray([0, len(own)])), 1)[0]
                mine = h[ends[r - i] : ends[r - i + 1]]
                if len(mine) and len(hub[1]):
                    small, large = sorted((mine, hub[1]), key=len)
                    if 100 * len(small) < percent * len(large):
                        continue
                    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                    both = int((large[at] == small).sum())
                    good[r] = 100 * both >= percent * (len(mine) + len(hub[1]) - both)
        yield pa.RecordBatch.from_arrays([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    n_bands = bands_for(percent)
    sig = cut(texts.mapInArrow(lambda b: trimmed(signed(b, n_bands)), SIGNED))
    classes = cut(
        sig.where("doc_id is not null and n_shingles > 0").groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    )
    edges = link_classes(texts, classes, percent)
    again = sig.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    rep = sig.join(classes.drop("bands"), ["n_shingles", "d1", "d2"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("rep"))
    edges = edges.unionByName(rep.join(again, "doc_id", "left_semi").where("rep is not null").select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    found = components(edges)
    out = rep.join(found, F.col("rep") == F.col("node"), "left")
    component = F.coalesce("component", "rep", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def intersections(h: np.ndarray, owner: np.ndarray, left: int, right: int) -> np.ndarray:
    """(left, right) sizes of the intersections of the first ``left`` sets with the ``right`` others; (h, owner) are
    the sets' elements, distinct within a set. Elements shared by both sides are expanded a stretch at a time."""
    counts = np.zeros(left * right, np.int64)
    order = np.lexsort((owner, h))
    h, owner = h[order], owner[order]
    begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    end = np.append(begin[1:], len(h))
    lefts = np.concatenate([[0], np.cumsum(owner < left)])
    nl = lefts[end] - lefts[begin]
    nr = end - begin - nl
    both = (nl > 0) & (nr > 0)
    begin, nl, nr = begin[both], nl[both], nr[both]
    size = nl * nr
    cuts = np.concatenate([[0], np.cumsum(size)])
    i = 0
    while i < len(size):
        j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + CROSSED, side="right")) - 1)
        token = np.repeat(np.arange(i, j), size[i:j])
        k = np.arange(cuts[j] - cuts[i]) - (cuts[token] - cuts[i])
        a = owner[begin[token] + k // nr[token]]
        b = owner[begin[token] + nl[token] + k % nr[token]] - left
        counts += np.bincount(a * right + b, minlength=left * right)
        i = j
    return counts.reshape(left, right)


def linked_blocks(table: pa.Table, percent: int) -> pa.Table:
    """Links between components among the texts of one or two blocks, at most one less than there are components."""
    side = table["side"].to_numpy()
    table = table.take(pa.array(np.argsort(side, kind="stable")))
    side, rep, comp = (table[c].to_numpy() for c in ("side", "rep", "comp"))
    left = int((side == 0).sum())
    one = left == len(side)
    data, offsets = utf8(table["text"])
    found = [(x, r + i) for i, j in chunks(offsets) for x, r in [shingles(*word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]), j - i)]]
    h, owner = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
    if one:  # a block with itself
        h, owner = np.concatenate([h, h]), np.concatenate([owner, owner + left])
        rep, comp = np.concatenate([rep, rep]), np.concatenate([comp, comp])
    n = np.bincount(owner, minlength=len(rep))
    both = intersections(h, owner, left, len(rep) - left)
    good = (100 * both >= percent * (n[:left, None] + n[None, left:] - both)) & (both > 0) & (comp[:left, None] != comp[None, left:])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in np.argwhere(good).tolist():
        a, b = root(int(comp[i])), root(int(comp[left + j]))
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((int(rep[i]), int(rep[left + j])))
    return pa.table([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], names=["a", "b"])


def link_classes(texts: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) between representatives that join what is linked (enough of them for the components)."""
    keyed = cut(classes.select("rep", F.explode("bands").alias("key")))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("least"), F.max("rep").alias("most")).where("least < most").select("key", "n")
    members = keyed.join(cut(sizes), "key")
    members = cut(members)
    few = few_tasks(members.count())
    degree = members.groupBy("rep").agg(F.sum("n").alias("degree")).coalesce(few)
    ranked = cut(members.select("key", "rep").join(degree, "rep").coalesce(few))
    hubs = ranked.groupBy("key").agg(F.min(F.struct((-F.col("degree")).alias("d"), "rep")).alias("h")).select("key", F.col("h.rep").alias("hub")).coalesce(few)
    met = cut(ranked.select("key", "rep").join(cut(hubs), "key").select("rep", "hub").distinct().coalesce(few))
    near = cut(texts.join(met.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"))
    with_texts = (
        met.where("rep <> hub").join(near.select(F.col("doc_id").alias("rep"), F.col("text").alias("text_a")), "rep")
        .join(near.select(F.col("doc_id").alias("hub"), F.col("text").alias("text_b")), "hub")
        .select("rep", "hub", "text_a", "text_b")
    )
    edges = cut(with_texts.mapInArrow(lambda b: trimmed(verified(b, percent)), "a long, b long").distinct().coalesce(few))
    found = components(edges)
    labelled = cut(met.join(found, F.col("rep") == F.col("node"), "left").select("rep", "hub", F.coalesce("component", "rep").alias("comp")).coalesce(few))
    in_blocks = cut(crossings(labelled).coalesce(few)).join(near.select(F.col("doc_id").alias("rep"), "text"), "rep")
    more = in_blocks.groupBy("hub", "kind", "i", "j").applyInArrow(lambda t: linked_blocks(t, percent), "a long, b long")
    return edges.unionByName(cut(more))


def crossings(labelled: DataFrame) -> DataFrame:
    """The members (rep, hub, comp) of the hubs that still have several components, once for each pair of blocks they are
    compared in: (hub, kind, i, j, side, rep, comp). A hub's largest component is never compared with itself: blocks of
    the other members meet its blocks (kind 0) and each other (kind 1). So one stray text in a group of n copies sends n
    texts; rows grow with (members outside the largest component) * (members) / BLOCK."""
    sizes = labelled.groupBy("hub", "comp").agg(F.count("*").alias("c"))
    split = sizes.groupBy("hub").agg(F.sum("c").alias("n"), F.max(F.struct("c", -F.col("comp"))).alias("big")).where(F.col("n") > F.greatest(F.col("big.c"), F.lit(2)))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    split = split.select("hub", (-F.col("big.col2")).alias("big"), blocks(F.col("big.c")).alias("nb"), blocks(F.col("n") - F.col("big.c")).alias("no"))
    rows = labelled.join(split, "hub").withColumn("odd", F.col("comp") != F.col("big"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("rep"), F.when(F.col("odd"), F.col("no")).otherwise(F.col("nb"))).cast("int"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), n - 1)).alias("other")
    own = ["hub", "rep", "comp", "block"]
    apart = rows.where("odd").select(*own, upto(F.col("nb"))).select("hub", F.lit(0).alias("kind"), F.col("block").alias("i"), F.col("other").alias("j"), F.lit(0).alias("side"), "rep", "comp")
    large = rows.where("not odd").select(*own, upto(F.col("no"))).select("hub", F.lit(0).alias("kind"), F.col("other").alias("i"), F.col("block").alias("j"), F.lit(1).alias("side"), "rep", "comp")
    among = rows.where("odd").select(*own, upto(F.col("no"))).select(
        "hub", F.lit(1).alias("kind"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "rep", "comp"
    )
    return apart.unionByName(large).unionByName(among)


def few_tasks(rows: int) -> int:
    """Tasks for slim rows: none under 100,000 rows, so that small inputs don't run hundreds of empty ones."""
    return max(8, rows // 100_000)


def drop_near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The documents kept (the smallest id of each group), with the input's columns."""
    name = fresh(docs.columns, "gone")
    gone = near_duplicates(docs, percent).where("not kept").select(F.col("doc_id").alias(name))
    return docs.join(gone.distinct(), F.col("doc_id").cast("long") == F.col(name), "left_anti")
