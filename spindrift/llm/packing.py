"""Order-preserving packing of documents into token windows by dynamic programming.

Documents are taken in the order of the table's partitions. Their token ids, each document closed by an end id, form
one stream per partition; windows are consecutive spans of it, so every id lies in exactly one piece. Cuts are chosen
at ends of documents (free), ends of sentences (a small penalty: a document is cut) or within
sentences, every few tokens (a larger one), so that padding plus penalties is least:

    cost(j) = penalty(j) + min over i with t(j) - t(i) <= width of cost(i) + width - (t(j) - t(i))

cost(i) + t(i) does not depend on j, so a monotone queue keeps the minimum of the sliding range and the whole
takes linear time. The stream is solved in stretches of some hundred windows; the last windows of a stretch are
solved again with the next, so that only a partition's last window can be short. No shuffle; memory holds a stretch
and the longest document.

Defined cases: a null or empty text is its end id alone; a null doc_id is kept as null; an empty table gives an empty
result; repeated rows are packed as often as they occur; other columns are left out.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from spindrift.llm.words import chunks, trimmed, utf8

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_tokens long"
SENTENCE_PENALTY, FORCED_PENALTY, FORCED_STEP = 4, 24, 32
#: Windows in a stretch, bytes of text whose words are looked up together, and words whose ids a Python worker keeps in
#: each of two generations (bounded memory; words that neither holds are encoded again).
STRETCH, CHUNK, WORDS_KEPT = 256, 1_000_000, 250_000
#: ASCII punctuation that may be cut off a word's end (what special tokens are written with stays).
TAIL = "!\"#$%&'()*+,-./:;=?@[\\]^_`{}~"


class Encoder:
    """Ids of words by one tokenizer, kept in two generations: a word that is met again moves to the young one; when that
    is full it becomes the old one, and what only the old one held is forgotten."""

    def __init__(self, name: str):
        import os

        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.sentence_end, self.word_end = np.zeros(65536, bool), np.zeros(65536, bool)
        for token, i in self.tokenizer.get_vocab().items():
            if i >= 65536:
                raise ValueError("ids of more than 16 bits are not supported")
            self.word_end[i] = token.endswith("</w>")
            self.sentence_end[i] = token.endswith("</w>") and token.removesuffix("</w>").rstrip("\"')")[-1:] in (".", "!", "?")

    def new(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words not kept. Words of letters alone are encoded many to a text, whose ids divide at the ends of
        words; where their number is not that of the words, and for other words, each is encoded by itself."""
        found: dict[str, bytes] = {}
        plain, single = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha()]
        for i in range(0, len(plain), 50_000):
            groups = [plain[k : k + 500] for k in range(i, min(i + 50_000, len(plain)), 500)]
            for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
                ids = np.asarray(e.ids, "<u2")
                ends = np.flatnonzero(self.word_end[ids]) + 1
                if len(ends) != len(group) or ends[-1] != len(ids):
                    single += group
                    continue
                data, ends = ids.tobytes(), (2 * ends).tolist()
                found.update(zip(group, map(data.__getitem__, map(slice, [0, *ends[:-1]], ends)), strict=True))
        for i in range(0, len(single), 20_000):
            part = single[i : i + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                found[w] = np.asarray(e.ids, "<u2").tobytes()
        return found

    def ids(self, words: list[str]) -> list[bytes]:
        """Little-endian 16-bit ids of each of the distinct words."""
        got = list(map(self.young.get, words))
        missing = [i for i, x in enumerate(got) if x is None]
        fresh = {w: x for w in map(words.__getitem__, missing) if (x := self.old.get(w)) is not None}
        fresh |= self.new([w for w in map(words.__getitem__, missing) if w not in fresh])
        for i in missing:
            got[i] = fresh[words[i]]
        if len(self.young) + len(fresh) > WORDS_KEPT:
            self.old, self.young = self.young, dict(zip(words, got, strict=True))
        else:
            self.young |= fresh
        return got


_encoders: dict[str, Encoder] = {}


def encoder(name: str) -> Encoder:
    """One a Python worker."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]


def parted(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Each word without the punctuation at its end, and that punctuation. The tokenizer never joins over the place
    between a letter or digit and what follows; where another character stands there, the word stays whole. Words of
    ASCII letters are told apart only in lower case, as by the tokenizer."""
    core = pc.utf8_rtrim(words, characters=TAIL)
    # (the letter U+0130 ends in a mark once it is lower-cased)
    ends = pc.and_not(pc.match_substring_regex(core, r"[\pL\pN]$"), pc.ends_with(core, "\u0130"))
    core = pc.if_else(ends, core, words)
    size, own = pc.binary_length(words).to_numpy(zero_copy_only=False), pc.binary_length(core).to_numpy(zero_copy_only=False)
    data, offsets = utf8(words)
    keep = np.repeat(own, size) <= np.arange(len(data)) - np.repeat(offsets[:-1], size)
    tail = pa.Array.from_buffers(pa.large_string(), len(words), [None, pa.py_buffer(np.append(0, np.cumsum(size - own)).astype(np.int64)), pa.py_buffer(data[keep])])
    return pc.if_else(pc.ascii_is_alpha(core), pc.ascii_lower(core), core), tail


def encode(texts: pa.Array, name: str) -> tuple[np.ndarray, np.ndarray]:
    """16-bit ids of all texts, and where each text's end. The tokenizer drops white space and never joins over it: each
    distinct word of the texts is looked up once, and the ids are gathered by word."""
    split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
    words = split.flatten().dictionary_encode()
    core, tail = parted(words.dictionary)
    known = pa.concat_arrays([core, tail]).dictionary_encode()
    each = encoder(name).ids(known.dictionary.to_pylist())
    ids, size = np.frombuffer(b"".join(each), "<u2"), np.fromiter(map(len, each), np.int32, len(each)) // 2
    begin = np.cumsum(size, dtype=np.int32) - size
    part = known.indices.to_numpy(zero_copy_only=False).reshape(2, -1).T[words.indices.to_numpy(zero_copy_only=False)].reshape(-1)
    size = size[part]
    ends = np.append(0, np.cumsum(size, dtype=np.int64))
    there = size > 0
    begin = begin[part[there]] - ends[:-1][there]
    gathered = ids[np.arange(ends[-1]) + np.repeat(begin, size[there])]
    return gathered, ends[2 * np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))]


def best_cuts(at: list[int], penalty: list[int], width: int) -> tuple[list[int], list[int]]:
    """Least cost and predecessor of each candidate; at[0] is the start, at ascends by steps of at most ``width``."""
    n = len(at)
    cost, before = [0] * n, [0] * n
    queue: deque[int] = deque([0])  # of candidates with rising cost + position
    for j in range(1, n):
        p = at[j]
        while p - at[queue[0]] > width:
            queue.popleft()
        i = queue[0]
        cost[j] = c = cost[i] + at[i] + width - p + penalty[j]
        before[j] = i
        c += p
        while queue and cost[k := queue[-1]] + at[k] >= c:
            queue.pop()
        queue.append(j)
    return cost, before


def candidates(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of allowed cuts in a stretch and their penalties, from 0 on."""
    penalty = np.full(len(ids) + 1, -1, np.int32)
    penalty[FORCED_STEP::FORCED_STEP] = FORCED_PENALTY
    penalty[1:][ends[ids]] = SENTENCE_PENALTY
    penalty[doc_ends] = 0
    penalty[0] = 0
    penalty[-1] = 0
    at = np.flatnonzero(penalty >= 0)
    return at, penalty[at]


def windows(ids: np.ndarray, doc_ends: np.ndarray, ends: np.ndarray, width: int, final: bool) -> list[int]:
    """Ends of the windows to write now. Unless ``final``, the last windows wait for what follows."""
    at, penalty = candidates(ids, doc_ends, ends)
    at, penalty = at.tolist(), penalty.tolist()
    cost, before = best_cuts(at, penalty, width)
    j = len(at) - 1
    if not final:
        least = at[-1] - width
        j = min((k for k in range(len(at) - 1, 0, -1) if at[k] > least), key=lambda k: (cost[k] + at[k], -k))
    found = []
    while j:
        found.append(at[j])
        j = before[j]
    found.reverse()
    return found if final else found[:-2]


def packed(batches: Iterator[pa.RecordBatch], name: str, end_id: int, width: int) -> Iterator[pa.RecordBatch]:
    ends = encoder(name).sentence_end
    partition = TaskContext.get().partitionId() if TaskContext.get() else 0
    sequence = partition << 40
    waiting: list[np.ndarray] = []  # ids not yet in a window
    docs: deque[list[int]] = deque()  # [doc_id, tokens in all, tokens written]
    held = 0

    def flush(final: bool) -> pa.RecordBatch:
        nonlocal waiting, held, sequence
        ids = np.concatenate(waiting)
        left = np.cumsum([total - done for _, total, done in docs])
        cuts = windows(ids, left, ends, width, final)
        rows, begin = [], 0
        for stop in cuts:
            offset = 0
            while begin + offset < stop:
                d = docs[0]
                take = min(stop - begin - offset, d[1] - d[2])
                piece = ids[begin + offset : begin + offset + take]
                rows.append((d[0], d[2], take, zlib.crc32(piece.astype("<u4").tobytes()), d[1], sequence, offset, stop - begin))
                d[2] += take
                offset += take
                if d[1] == d[2]:
                    docs.popleft()
            begin, sequence = stop, sequence + 1
        waiting, held = [ids[begin:].copy()], len(ids) - begin
        names = [f.split()[0] for f in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * len(names), names=names)

    for batch in batches:
        keys, texts = batch.column(0).to_pylist(), batch.column(1).fill_null("")
        for i, j in chunks(utf8(texts)[1], CHUNK):
            found, stops = encode(texts.slice(i, j - i), name)
            pa.default_memory_pool().release_unused()  # else what chunks leave free adds up over a task
            own = np.insert(found, stops, end_id)
            stops = stops + np.arange(1, j - i + 1)
            begin = 0
            for k, stop in zip(keys[i:j], stops.tolist(), strict=True):
                waiting.append(own[begin:stop])
                docs.append([k, stop - begin, 0])
                held += stop - begin
                begin = stop
                if held >= STRETCH * width:
                    yield flush(False)
    if held:
        yield flush(True)


def pack(docs: DataFrame, width: int = 4096, name: str = "word_bpe_49k.json", end_id: int = 2) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, sequence_tokens."""
    return docs.selectExpr("cast(doc_id as long) doc_id", "cast(text as string) text").mapInArrow(lambda b: trimmed(packed(b, name, end_id, width)), SCHEMA)
