"""The span classifier: what it reads beside the votes, planted data by kind, and clean texts."""

from __future__ import annotations

import collections
import random

import numpy as np

from spindrift.llm import pii

FILLER = "the of and report table result value first second order garden river window paper".split()


def spans_by_id(df):
    return {r.doc_id: [x.split(":") for x in r.spans.split(",") if x] for r in df.collect()}


def number(rng):
    return f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{rng.randrange(1000, 9999)}"


def test_words_beside_a_span_decide(spark, docs):
    """Votes for the last two texts are the same; only the word before the number tells them apart."""
    rng = random.Random(5)
    rows = [(i, f"tel rufnummer {number(rng)} end") for i in range(150)]
    rows += [(200 + i, f"garden artikel {number(rng)} end") for i in range(150)]
    rows += [(400 + i, f"mail a{i}@b.com, tel +1234567890{i % 10}, no 300.1.1.{i}") for i in range(100)]
    rows += [(900, f"garden rufnummer {number(rng)} end"), (901, f"river artikel {number(rng)} end")]
    got = spans_by_id(pii.find_personal_data(docs(rows)))
    assert [k for k, *_ in got[900]] == ["phone"] and got[901] == []
    assert all(len(got[i]) == 1 for i in range(150)) and not any(got[200 + i] for i in range(150))


def test_planted_recall_by_kind(spark, docs):
    rng = random.Random(7)
    words = lambda n: " ".join(rng.choices(FILLER, k=n))
    make = {
        "email": lambda: rng.choice([f"reach user{rng.randrange(99)}@mail.example.com", f"write to user{rng.randrange(99)} [at] example [dot] com"]),
        "ip": lambda: f"host {rng.randrange(1, 223)}.{rng.randrange(256)}.{rng.randrange(256)}.{rng.randrange(256)}",
        "card": lambda: "card " + rng.choice(["4532 0151 1283 0366", "4532015112830367"]),
        "phone": lambda: rng.choice([f"call +1 {number(rng)}", f"call {number(rng)}"]),
        "secret": lambda: f'token = "{rng.randbytes(10).hex()}1a"',
        "ssn": lambda: f"social security {rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)}",
        "iban": lambda: f"bank account DE{rng.randrange(10, 99)} 3704 0044 0532 {rng.randrange(1000, 9999)} 00",
    }
    rows, want = [], {}
    for i in range(420):
        kind = list(make)[i % len(make)]
        before, span = words(6), make[kind]()
        rows.append((i, f"{before} {span} {words(6)}"))
        failing = kind == "card" and span.endswith("0367")
        want[i] = None if failing else kind
    rows += [(1000 + i, words(40) + f" {rng.randrange(10**6)} 300.400.1.{i} v1.2.3 20-{i}-7") for i in range(200)]
    got = spans_by_id(pii.find_personal_data(docs(rows)))
    hits, total = collections.Counter(), collections.Counter()
    for i, kind in want.items():
        if kind:
            total[kind] += 1
            hits[kind] += any(k == kind for k, *_ in got[i])
    assert all(hits[k] > 0.9 * total[k] for k in make), (hits, total)
    assert not any(got[1000 + i] for i in range(200))


def test_evidence_and_slopes():
    sums = [(5, 1, 3, 90.0, 100), (5, 1, 4, 10.0, 100), (5, 1, 9, 1.0, 1), (0, 2, 0, 0.0, 50)]
    e = pii.evidence(sums)
    assert e.shape == (len(pii.FEATURES), len(pii.SOURCES), pii.BUCKETS)
    assert e[1, 5, 3] > 1 > -1 > e[1, 5, 4] and 0 < e[1, 5, 9] < 0.5 and np.abs(e).max() <= pii.MOST
    share = (101 + 0.5) / (201 + 1)
    odds = lambda p, n: np.log((p + pii.PRIOR * share) / (n - p + pii.PRIOR * (1 - share))) - np.log(share / (1 - share))
    assert np.isclose(e[1, 5, 3], odds(90, 100)) and np.isclose(e[1, 5, 7], 0)
    told = [(5, (0, 2, 0), 88.0, 100), (5, (0, -2, 0), 12.0, 100), (5, (0, 0, 3), 50.0, 100), (5, (0, 0, -3), 50.0, 100)]
    shape, left, right = pii.slopes(told)
    assert left > 0.8 and right < 0.1 and 0 <= shape <= 1
    assert pii.slopes([]) == [0.0] * len(pii.FEATURES) and not np.abs(pii.evidence([])).max()


def test_without_candidates(spark, docs):
    assert spans_by_id(pii.find_personal_data(docs([(1, "nothing here"), (2, None), (3, "")]))) == {1: [], 2: [], 3: []}
    assert pii.find_personal_data(docs([])).count() == 0 and pii.mask(docs([])).count() == 0
