"""Words and word shingles of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes other than 0x20 and 0x09-0x0D; A-Z are lower-cased first. A word's hash is a polynomial
over its bytes modulo 2**64, mixed; prefix sums give the hashes of all words without a loop over words.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa

#: Bytes worked on at a time; a longer single text is still taken whole.
CHUNK_BYTES = 1_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IN_WORD = np.ones(256, dtype=bool)
IN_WORD[[0x20, *range(0x09, 0x0E)]] = False


def trimmed(batches):
    """The batches, and then what the process's allocators hold but do not use goes back: workers live on after tasks."""
    yield from batches
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over uint64 (xor-shift and multiply, twice)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (one more than rows) of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES):
    """Ranges of rows (i, j) whose bytes stay within ``most``, or of one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i below n, kept between calls up to twice CHUNK_BYTES."""
    if len(_powers[0]) >= n:
        return _powers[0], _powers[1]
    size = max(n, CHUNK_BYTES + 1)
    out = []
    for b in (BASE, BASE_INVERSE):
        x = np.full(size, b, np.uint64)
        x[0] = 1
        out.append(np.multiply.accumulate(x))
    if size <= 2 * CHUNK_BYTES:
        _powers[:] = out
    return out[0], out[1]


def word_spans(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word."""
    inside = in_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray = IN_WORD) -> tuple[np.ndarray, np.ndarray]:
    """uint64 hash and row of every word, in order of text."""
    starts, ends, rows = word_spans(data, offsets, in_word)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts]), rows


def hash_word(word: str) -> int:
    """The same hash for one word."""
    return int(word_hashes(*utf8(pa.array([word])))[0][0])


def shingles(words: np.ndarray, rows: np.ndarray, n_rows: int, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and their rows. Fewer words than ``size``: the whole sequence as one."""
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys = [np.uint64(int(pow(0xD6E8FEB86659FD93, k + 1, 2**64))) for k in range(size)]
    counts = np.bincount(rows, minlength=n_rows)
    found, owner = [], []
    if len(words) >= size:
        n = len(words) - size + 1
        h = np.zeros(n, np.uint64)
        for k in range(size):
            h += words[k : k + n] * keys[k]
        whole = rows[:n] == rows[size - 1 :]
        found.append(mix(h[whole]))
        owner.append(rows[:n][whole])
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    for r in np.flatnonzero((counts > 0) & (counts < size)):
        h = np.asarray([counts[r]], np.uint64) * np.uint64(0xA0761D6478BD642F)
        for k in range(counts[r]):
            h = mix(h + words[first[r] + k : first[r] + k + 1] * keys[k])
        found.append(h)
        owner.append(np.asarray([r]))
    h, r = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((h, r))
    h, r = h[order], r[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    return h[new], r[new]
