"""Language identification by a convolutional network over bytes.

A text is cut into windows of WINDOW bytes (each sees SPAN - 1 bytes of the next, so no byte run is lost). A window's
bytes are embedded, filters of several widths run over them, the largest response of each filter is kept, and a
softmax layer gives the languages. A document's logits are the mean of its windows' logits, weighted by their bytes.
The network is trained in numpy on a bounded sample (``per_lang`` documents a language and ``pieces`` windows a
document, both parameters) of labelled rows; only text and lang are learnt from, and only text is predicted from.

Defined cases: null texts and texts without a letter give ``und`` and 0.0; so does every text when no row is labelled;
a null doc_id counts as the empty string where ids are hashed; very long texts are read whole, in windows; an empty
table gives an empty result; other columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.llm.shared import fresh
from spindrift.llm.words import LOWER, chunks, trimmed, utf8

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4), 16, 8
SPAN = max(WIDTHS)
SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


@dataclass
class Network:
    langs: list[str]
    embed: np.ndarray  # (256, DIM), row 0 stays zero: padding
    conv: np.ndarray  # (SPAN * DIM, len(WIDTHS) * FILTERS), zero beyond a filter's width
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray


def conv_mask() -> np.ndarray:
    """1 where a filter of its width has a weight."""
    mask = np.zeros((SPAN * DIM, len(WIDTHS) * FILTERS), np.float32)
    for i, w in enumerate(WIDTHS):
        mask[: w * DIM, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def columns(net: Network, windows: np.ndarray) -> np.ndarray:
    """(windows, positions, SPAN * DIM): the embedded bytes that each position's filters see."""
    x = net.embed[windows]
    return np.concatenate([x[:, k : k + WINDOW] for k in range(SPAN)], axis=2)


def responses(net: Network, windows: np.ndarray, tile: int = 8) -> np.ndarray:
    """Largest response of each filter in each window, after the rectifier."""
    out = np.empty((len(windows), net.conv.shape[1]), np.float32)
    for i in range(0, len(windows), tile):
        x = columns(net, windows[i : i + tile])
        out[i : i + tile] = (x.reshape(-1, SPAN * DIM) @ net.conv).reshape(len(x), WINDOW, -1).max(axis=1)
    return np.maximum(out + net.bias, 0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (bytes, lower-cased, zero-padded), their rows and their lengths."""
    sizes = np.diff(offsets)
    per = -(-sizes // WINDOW)
    rows = np.repeat(np.arange(len(sizes)), per)
    first = np.concatenate([[0], np.cumsum(per)])[:-1]
    begin = offsets[rows] + WINDOW * (np.arange(len(rows)) - first[rows])
    end = offsets[rows + 1]
    at = begin[:, None] + np.arange(WINDOW + SPAN - 1)
    inside = at < end[:, None]
    windows = np.where(inside, LOWER[data[np.minimum(at, max(len(data) - 1, 0))]], 0) if len(rows) else np.zeros((0, WINDOW + SPAN - 1), np.uint8)
    return windows, rows, np.minimum(WINDOW, end - begin)


def train(texts: list[str], labels: list[str], seed: int = 7, epochs: int = 8, batch: int = 64, rate: float = 4e-3) -> Network:
    """Adam on the cross entropy of single windows."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    data, offsets = utf8(pa.array(texts, pa.string()))
    windows, rows, _ = cut_windows(data, offsets)
    y = np.asarray([langs.index(x) for x in labels])[rows]
    n, k = len(WIDTHS) * FILTERS, len(langs)
    mask = conv_mask()
    embed = rng.normal(0, 0.5, (256, DIM)).astype(np.float32)
    embed[0] = 0
    net = Network(langs, embed, (rng.normal(0, 0.3, mask.shape) * mask).astype(np.float32), np.zeros(n, np.float32), rng.normal(0, 0.1, (n, k)).astype(np.float32), np.zeros(k, np.float32))
    names = ["embed", "conv", "bias", "out", "out_bias"]
    first = {p: np.zeros_like(getattr(net, p)) for p in names}
    second = {p: np.zeros_like(getattr(net, p)) for p in names}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(windows))
        for i in range(0, len(order), batch):
            pick = order[i : i + batch]
            w, b = windows[pick], len(pick)
            x = columns(net, w)
            z = (x.reshape(-1, SPAN * DIM) @ net.conv).reshape(b, WINDOW, n)
            at = z.argmax(axis=1)
            top = np.take_along_axis(z, at[:, None, :], 1)[:, 0] + net.bias
            h = np.maximum(top, 0)
            d = softmax(h @ net.out + net.out_bias)
            d[np.arange(b), y[pick]] -= 1
            d /= b
            g = {"out": h.T @ d, "out_bias": d.sum(0)}
            dh = (d @ net.out.T) * (top > 0)
            seen = x[np.arange(b)[:, None], at]  # (b, n, SPAN * DIM)
            g["bias"] = dh.sum(0)
            g["conv"] = np.einsum("bf,bfd->df", dh, seen) * mask
            dx = (dh[:, :, None] * net.conv.T[None]).reshape(b, n, SPAN, DIM)
            g["embed"] = np.zeros_like(net.embed)
            for s in range(SPAN):
                np.add.at(g["embed"], w[np.arange(b)[:, None], at + s], dx[:, :, s])
            g["embed"][0] = 0
            step += 1
            pace = rate * (1 - epoch / (epochs + 1))
            for p in names:
                first[p] = 0.9 * first[p] + 0.1 * g[p]
                second[p] = 0.999 * second[p] + 0.001 * g[p] ** 2
                v = getattr(net, p)
                v -= (pace * (first[p] / (1 - 0.9**step)) / (np.sqrt(second[p] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def scrambled(text: str, seed: int) -> str:
    """The text's characters in random order: what has the letters of a language and is none."""
    order = np.random.default_rng(seed).permutation(len(text))
    return "".join(text[i] for i in order)


def fit(docs: DataFrame, per_lang: int = 400, pieces: int = 4, most_langs: int = 1000, noise: bool = False) -> Network | None:
    """Train on the ``most_langs`` most frequent languages (the network has an output for each) and at most ``per_lang`` documents of each language outside the held-out third, taken evenly by a hash of
    their ids and texts (of equal rows, as many as there is room for), and on ``pieces`` windows at hashed places of each. With ``noise`` the network
    also learns ``und``, from scrambled windows of the sample, as many as a language has."""
    rows = docs.select("doc_id", "text", "lang", F.xxhash64("doc_id", "text").alias("pick")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id")))
    share = rows.groupBy("lang").agg((F.lit(2 * per_lang * 1_000_000.0) / F.count("*")).alias("most")).orderBy("most", "lang").limit(most_langs)
    places = F.transform(
        F.sequence(F.lit(0), F.lit(pieces - 1)),
        lambda j: F.substring("text", F.pmod(F.xxhash64("pick", j), F.greatest(F.length("text") - 200, F.lit(1))).cast("int") + 1, F.lit(WINDOW)),
    )
    # about twice as many, so that few rows are ranked; the rank then sets the bound
    some = rows.join(F.broadcast(share), "lang").where(F.pmod("pick", F.lit(1_000_000)) < F.col("most")).select("doc_id", "lang", "pick", places.alias("windows"))
    some = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("pick", "doc_id"))).where(F.col("rank") <= per_lang)
    got = sorted((r[0], r[1], i, x) for r in some.select("pick", "lang", "windows").collect() for i, x in enumerate(r[2]))
    if not got:
        return None
    texts, langs = [x[3].encode()[:WINDOW].decode(errors="ignore") for x in got], [x[1] for x in got]
    if noise:  # as many as a language has windows
        some = [i for i in range(len(texts)) if i % len(set(langs)) == 0]
        texts, langs = texts + [scrambled(texts[i], i) for i in some], langs + ["und"] * len(some)
    return train(texts, langs)


def predicted(batches: Iterator[pa.RecordBatch], net: Network | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column(1))
        lettered = batch.column(3).to_numpy(zero_copy_only=False).astype(bool)
        langs, scores = ["und"] * len(lettered), np.zeros(len(lettered))
        for i, j in chunks(offsets) if net else ():
            w, rows, sizes = cut_windows(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            z = np.zeros((j - i, len(net.langs)))
            for a in range(0, len(w), 4096):
                logits = responses(net, w[a : a + 4096]) @ net.out + net.out_bias
                np.add.at(z, rows[a : a + 4096], logits * sizes[a : a + 4096, None])
            p = softmax(z / np.maximum(1, np.diff(offsets[i : j + 1]))[:, None])
            for r in np.flatnonzero(lettered[i:j]):
                k = int(p[r].argmax())
                langs[i + r], scores[i + r] = net.langs[k], min(1.0, float(p[r, k]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(langs), pa.array(scores)], names=["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, per_lang: int = 400, pieces: int = 4, net: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    net = net or fit(docs, per_lang, pieces)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    return rows.mapInArrow(lambda b: trimmed(predicted(b, net)), SCHEMA)


def keep_identified(docs: DataFrame, least: float = 3.0, **fit_options: int) -> DataFrame:
    """Documents in which a language can be told, with the input's columns. Rejected are texts without a letter and those
    that the network holds for letters of no language (``und``, learnt from scrambled windows), if the log odds of that,
    times the text's bytes in windows, reach ``least``: a few words with a number or an address are never enough. Where no row has a label, nothing is known of languages and only texts without a letter go. A
    row's decision is taken where the row is read; nothing is joined."""
    net = fit(docs, noise=True, **fit_options)
    lettered = F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False))
    if net is None:
        return docs.where(lettered)
    names = docs.columns
    extra = {n: fresh(names, n) for n in ("doc_id", "text", "held_out", "lettered")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lean = pa.RecordBatch.from_arrays(batch.columns[len(names) :], names=list(extra))
            found = next(predicted(iter([lean]), net))
            p = np.clip(found.column(3).to_numpy(), 1e-9, 1 - 1e-9)
            size = pc.fill_null(pc.binary_length(lean.column(1)), 0).to_numpy(zero_copy_only=False)
            none = pc.and_(pc.equal(found.column(2), "und"), pa.array(np.log(p / (1 - p)) * size / WINDOW >= least))
            good = pc.and_(lean.column(3), pc.invert(none))
            yield pa.RecordBatch.from_arrays(batch.columns[: len(names)], names=names).filter(good)

    rows = docs.select(*names, F.col("doc_id").cast("long").alias(extra["doc_id"]), F.col("text").cast("string").alias(extra["text"]), held_out(F.col("doc_id")).alias(extra["held_out"]), lettered.alias(extra["lettered"]))
    return rows.mapInArrow(lambda b: trimmed(run(b)), docs.schema)
