"""Runs of words against a plain search, and the digests against plain code."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from spindrift.llm import periodic
from tests.llm import brute

RNG = random.Random(11)


def plain_runs(w, least=6, times=4):
    found = set()
    for q in range(1, len(w) // times + 1):
        i = 0
        while i < len(w) - q:
            j = i
            while j < len(w) - q and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, times * q) and not any(w[i : j + q - p] == w[i + p : j + q] for p in range(1, q)):
                found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def odd_words(rng=RNG):
    """Words of a small vocabulary with planted repeats, at times within each other."""
    n, kinds = rng.randint(0, 90), rng.choice([1, 2, 3, 5, 30])
    w = [rng.randrange(kinds) for _ in range(n)]
    for _ in range(rng.randint(0, 3) if n else 0):
        a, p = rng.randrange(n), rng.randint(1, 9)
        part = w[a : a + p]
        w = w[:a] + (part * 8)[: rng.randint(1, 6 * len(part)) if part else 0] + w[a + p :]
    return w


@pytest.mark.parametrize("times", [4, 6])
def test_runs(times):
    for _ in range(1500):
        texts = [odd_words() for _ in range(RNG.randint(1, 4))]
        begins = np.cumsum([0, *map(len, texts)])
        got = periodic.runs_of(np.asarray(sum(texts, []), np.int64), np.repeat(np.arange(len(texts)), np.diff(begins)), times=times)
        assert [tuple(r) for r in got.tolist()] == [(s + begins[d], n, q) for d, w in enumerate(texts) for s, n, q in plain_runs(w, times=times)]


def test_one_word_and_long_periods():
    w = [0] * 3000 + list(range(1, 400)) * 5 + [0] * 6
    assert periodic.runs_of(np.asarray(w), np.zeros(len(w), np.int64)).tolist() == [[0, 3000, 1], [3000, 1995, 399], [4995, 6, 1]]


def plain_digest(doc_id, text):
    w = (text or "").encode()
    w = brute.WORD.findall(w)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()), sha(b" ".join(x for i, x in enumerate(w) if i not in dropped)),
    )


def test_digests(spark, docs):
    rows = [(i, " ".join(f"w{x}" for x in odd_words())) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n\t "), (203, "one"), (None, "a b a b a b a b a b"), (204, "É é É é É é É é É é x\x0b\x0cx"), (205, "A a A a A a A a A a"), (206, "z " * 1500), (206, "z " * 1500)]
    got = periodic.run_digests(docs(rows, extra=True))
    assert got.dtypes == [("doc_id", "bigint"), ("n_runs", "bigint"), ("start", "bigint"), ("length", "bigint"), ("period", "bigint"), ("exponent_milli", "bigint"), ("runs_sha256", "string"), ("collapsed_sha256", "string")]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((plain_digest(*r) for r in rows), key=repr)
    assert periodic.run_digests(docs([])).count() == 0


def test_texts_of_the_operator(spark, docs):
    got = {r.doc_id: r for r in periodic.periodic_runs(docs([(1, "x go on go on go on go on y"), (10, "  no  run ")])).collect()}
    assert got[1].collapsed == "x go on y" and [tuple(r) for r in got[1].runs] == [(1, 8, 2)]
    assert got[10].collapsed == "no run" and got[10].runs == []
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs([]), least=4)
