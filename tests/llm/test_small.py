"""Each operator against a plain version on small inputs with nulls, repeats, empty and long texts."""

import collections
import hashlib
import json
import math
import random
import subprocess
import sys
import zlib

import numpy as np
import pyarrow as pa
import pytest

from spindrift.llm import decontamination, extraction, langid, language_model, licences, neardup, neighbours, packing, pii, sharding, words
from spindrift.llm.shared import components
from spindrift.sources.session import ROOT
from tests.llm import brute

RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefgh") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def edited(text, n, rng=RNG):
    w = text.split(" ")
    for _ in range(n):
        w[rng.randrange(len(w))] = "edit" + str(rng.random())
    return " ".join(w)


ODD = [(1001, None), (1002, ""), (1003, " \n\t "), (1004, "one"), (1005, "one"), (None, "lost words of nobody at all here"), (1006, "É é \U0001f600 x"), (1007, "x" * 50_000)]


def copies():
    """Groups of near copies round an original, at many distances, and unrelated texts."""
    rows, n = [], 0
    for size in (70, 100, 140, 300):
        base = prose(size)
        for k in range(14):
            rows.append((n, edited(base, k % 7)))
            n += 1
    for _ in range(25):
        rows.append((n, prose(60)))
        n += 1
    base = prose(90)
    rows += [(n + i, base) for i in range(20)]
    return rows


def test_words():
    texts = ["A bc\tD", "", None, "ünï x\x0by", "a  ", " q"]
    h, rows = words.word_hashes(*words.utf8(pa.array(texts)))
    flat = [(i, w) for i, t in enumerate(texts) for w in brute.words(t)]
    assert rows.tolist() == [i for i, _ in flat]
    assert {(a, b) for a, b in zip(h.tolist(), [w for _, w in flat], strict=True)} == {(words.hash_word(w.decode()), w) for _, w in flat}
    s, owner = words.shingles(h, rows, len(texts))
    assert np.bincount(owner, minlength=len(texts)).tolist() == [len(brute.shingle_set(t)) for t in texts]


def test_super_minhash_estimates_similarity():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    other = np.concatenate([base[:270], rng.integers(0, 2**63, 30).astype(np.uint64)])
    sig = neardup.super_minhash(np.concatenate([base, other, base[:1]]), np.repeat([0, 1, 2], [300, 300, 1]), 4)
    assert abs((sig[0] == sig[1]).mean() - 270 / 330) < 0.15
    assert np.isfinite(sig[:3]).all() and np.isinf(sig[3]).all()
    assert sorted(np.floor(sig[2]).tolist()) == list(range(neardup.SIZE))  # one element fills every place once


@pytest.mark.parametrize("block", [8, 256])
def test_near_duplicates(spark, docs, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = copies()
    got = {r.doc_id: r for r in neardup.near_duplicates(docs(rows + ODD, extra=True)).collect()}
    wanted, sets = brute.components({i: t for i, t in rows + ODD if i is not None})
    for i, c in wanted.items():
        assert (got[i].component_id, got[i].n_shingles, got[i].kept) == (c, len(sets[i]), c == i)
    assert got[None].component_id is None and got[None].kept
    kept = neardup.drop_near_duplicates(docs(rows + ODD).selectExpr("*", "1 AS gone", "2 AS __gone", "3 AS kept")).select("doc_id").collect()
    assert {r[0] for r in kept} == {i for i, c in wanted.items() if c == i} | {None}


def test_pipeline_drops_copies_of_similarity_080(spark, docs):
    import corpus_pipeline

    rows = copies()
    wanted, _ = brute.components(dict(rows), percent=80)
    loose, _ = brute.components(dict(rows))
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs(rows), "").collect()}
    assert kept == {i for i, c in wanted.items() if c == i} != {i for i, c in loose.items() if c == i}
    assert [(neardup.bands_for(p), (1 - (p / 100) ** 4) ** neardup.bands_for(p) < 7.5e-6) for p in (85, 80)] == [(16, True), (23, True)]


def test_near_duplicates_of_repeated_ids(spark, docs):
    a, b = prose(80), prose(80)
    got = neardup.near_duplicates(docs([(5, a), (5, b), (7, a), (3, b), (9, prose(70))])).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(3, 3), (5, 3), (5, 3), (7, 3), (9, 9)]
    assert neardup.near_duplicates(docs([])).count() == 0


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(None, 3), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges if None not in e for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    assert all(got.get(x, x) == root(x) for x in parent)


def test_decontamination(spark, docs):
    rng = random.Random(9)
    items = [(0, prose(30, rng)), (1, prose(16, rng)), (2, prose(5, rng)), (3, None), (4, " .,; "), (5, prose(30, rng)), (None, prose(40, rng))]
    rows = list(ODD)
    for i in range(60):
        item = items[rng.choice([0, 1, 2, 5, 6])][1]
        cut = item.split(" ")
        for _ in range(i % 9):
            kind, at = rng.randrange(3), rng.randrange(len(cut))
            cut[at : at + 1] = [] if kind == 0 and len(cut) > 1 else ["zz" + str(i)] if kind == 1 else [cut[at], "yy" + str(i)]
        rows.append((i, f"{prose(rng.randrange(40), rng)} {' '.join(cut).upper()}!!! {prose(rng.randrange(40), rng)}"))
    got = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs(rows, extra=True), spark.createDataFrame(items, "item_id long, text string")).collect()}
    plain = lambda t: "".join(c if c.isalnum() else " " for c in t.lower()).split()
    wanted = {}
    for i, t in rows:
        for k, item in items:
            n = plain(item or "")
            if n and (d := brute.edit_distance_within(n, plain(t or ""))) <= decontamination.budget(len(n)):
                wanted[i, k] = d
    assert {k: r.distance for k, r in got.items()} == wanted and len(wanted) > 20
    for (i, _), r in got.items():
        assert 0 <= r.first_word <= r.end_word <= len(plain(dict(rows)[i]))
    clashing = docs(rows).selectExpr("*", "1 AS leak", "2 AS __leak", "3 AS item_id")
    kept = decontamination.drop_contaminated(clashing, spark.createDataFrame(items, "item_id long, text string"))
    assert kept.count() == len(rows) - len({i for i, _ in wanted}) and kept.columns == clashing.columns
    assert decontamination.find_leaks(docs(rows), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_myers():
    rng = random.Random(4)
    for _ in range(300):
        p, t = ([rng.randrange(4) for _ in range(rng.randrange(a, 80))] for a in (1, 0))
        masks = collections.defaultdict(int)
        for i, w in enumerate(p):
            masks[w] |= 1 << i
        assert min(decontamination.myers(masks, len(p), t, len(p))[0], len(p)) == brute.edit_distance_within(p, t)


def pieces_fit(got, rows, width):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 2] for i, x in rows}
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        own = np.asarray(ids[r.doc_id][r.start : r.start + r.length], "<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id]) and r.length > 0
        by_doc[r.doc_id].append((r.start, r.length))
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for i, x in ids.items():
        at = 0
        for start, length in sorted(by_doc[i]):
            assert start == at
            at += length
        assert at == len(x)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
    return by_sequence


def test_packing(spark, docs):
    rng = random.Random(8)
    rows = [(i, ". ".join(prose(rng.randrange(1, 30), rng) for _ in range(rng.randrange(1, 30)))) for i in range(150)] + ODD
    got = packing.pack(docs(rows, extra=True).coalesce(1), width=512).collect()
    sequences = pieces_fit(got, rows, 512)
    total = sum(n for parts in sequences.values() for _, n in parts)
    assert 1 - total / (512 * len(sequences)) < 0.05
    assert packing.pack(docs([])).count() == 0
    assert [(r.length, r.doc_tokens) for r in packing.pack(docs([(1, None)])).collect()] == [(1, 1)]


def test_packing_takes_little_memory():
    """Over 24 MB of mostly new words a worker takes at most 160 MB besides its tokenizer's: what it knows of words and
    what chunks leave free are bounded."""
    code = """if True:
        import random, re, threading, time, pyarrow as pa
        from spindrift.llm import packing
        used = lambda: sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+([0-9]+)", open("/proc/self/smaps_rollup").read()))) / 1024
        packing.encoder("word_bpe_49k.json")
        rng, first, most, ends = random.Random(2), used(), [0], []
        word = lambda: "".join(rng.choices("abcdefghijklmnop", k=rng.randint(4, 10)))
        often = [word() for _ in range(2000)]
        def watch():
            while not ends:
                most[0] = max(most[0], used())
                time.sleep(0.02)
        def batches():
            for i in range(12):
                texts = [" ".join(word() if rng.random() < 0.3 else rng.choice(often) for _ in range(500)) for _ in range(500)]
                yield pa.RecordBatch.from_arrays([pa.array(range(500 * i, 500 * i + 500)), pa.array(texts)], names=["doc_id", "text"])
        watcher = threading.Thread(target=watch)
        watcher.start()
        n = sum(b.num_rows for b in packing.packed(batches(), "word_bpe_49k.json", 2, 4096))
        ends.append(1)
        watcher.join()
        print(n >= 6000, round(most[0] - first))
    """
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True).stdout.split()
    assert out[0] == "True" and int(out[1]) <= 160, out


def test_packing_finds_the_least_cost():
    rng = random.Random(6)
    for _ in range(60):
        at = sorted({0, *rng.sample(range(1, 60), 12), 60})
        penalty = [rng.randrange(9) for _ in at]
        width = max(20, *[b - a for a, b in zip(at, at[1:], strict=False)])
        cost, _ = packing.best_cuts(at, penalty, width)
        best = [0] + [math.inf] * (len(at) - 1)
        for j in range(1, len(at)):
            best[j] = penalty[j] + min(best[i] + width - (at[j] - at[i]) for i in range(j) if at[j] - at[i] <= width)
        assert cost == best


@pytest.mark.parametrize("n", [0, 1, 2, 3, 40, 41, 97, 1000])
def test_sharding(spark, docs, n):
    rows = [(RNG.choice([None, i, i // 2]), RNG.choice(["", None, "é" * (i % 5), "same"])) for i in range(n)]
    got = sharding.shard_documents(docs(rows, extra=True), shards=7).collect()
    assert len(got) == n and sorted(r.row_no for r in got) == list(range(n))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.size, r.text_crc32) for r in got) == sorted((i is None, i or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and all(len(s) in (n // 7, -(-n // 7)) for s in by.values())
    assert got and {(r.row_no, r.shard, r.slot) for r in got} == {(r.row_no, r.shard, r.slot) for r in sharding.shard_documents(docs(rows).repartition(5), shards=7).collect()} or n == 0


def test_permutation_is_spread(spark):
    n = 5003
    p = [r[0] for r in spark.range(n).select(sharding.permute(sharding.feistel(sharding.F.col("id"), *sharding.halves(n), 1), n, 1)).collect()]
    assert sorted(p) == list(range(n)) and abs(np.corrcoef(range(n), p)[0, 1]) < 0.1


def test_personal_data(spark, docs):
    rows = [
        (1, "a@b.com_x@y.com mail 1.2.3.4.5 +1 (743) 555-3824, call (743) 555-3824"), (2, "999.1.2.3 4532 0151 1283 0366 and 4532015112830367 +1234"), (3, "\U0001f600 é +12345678901 token = \"abcdef0123456789\""),
        (4, "9" * 20_000), (5, "a" * 100_000 + "@"), (6, "1.2.3.4.5.6.7.8 " * 300), (7, "+1+1+1 2222222222 x@y.z-.q"), *ODD,
    ]
    got = pii.find_personal_data(docs(rows, extra=True)).collect()
    assert len(got) == len(rows)
    texts = collections.defaultdict(list)
    for i, t in rows:
        texts[i].append(t)
    for r in got:
        base = brute.personal(texts[r.doc_id][0])
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        counts = collections.Counter(b.split(":")[0] for b in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
        assert set(base) <= set(r.spans.split(",")) | {""}
    masked = {r.doc_id: r for r in pii.mask(docs(rows)).collect()}
    assert masked[1].text.startswith("<EMAIL><EMAIL> mail <IP>.5 <PHONE>") and masked[1].n_chars == len(masked[1].text)
    assert masked[1001].text is None and masked[1004].text == "one"
    assert pii.find_personal_data(docs([])).count() == 0


def test_added_spans(spark, docs):
    text = 'Write to j.doe [at] example [dot] com, call (212) 555-0100. SSN: 123-45-6789, IBAN DE89 3704 0044 0532 0130 00, password = "hunter22x"'
    rows = [(i, f"mail a{i}@b.com tel +1234567890{i % 10} no {i}{i + 7} 300.1.1.{i} done") for i in range(40)] + [(99, text)]
    spans = {r.doc_id: r.spans for r in pii.find_personal_data(docs(rows)).collect()}[99].split(",")
    found = sorted((int(a), int(b)) for _, a, b in (x.split(":") for x in spans))
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:], strict=False))
    assert {"ssn", "iban", "secret"} <= {x.split(":")[0] for x in spans}


def test_overlaps_by_brute_force(spark):
    rng = random.Random(11)
    rows = []
    for i in range(60):
        n = rng.randrange(0, 200)
        spans = [(a, rng.random() < 0.7, a + rng.randrange(1, 30), rng.randrange(7)) for a in (rng.randrange(0, 1500) for _ in range(n))]
        rows.append((i, [s for s in spans if not s[1]], [s for s in spans if s[1]]))
    span = "array<struct<start:int,added:boolean,stop:int,kind:int>>"
    df = spark.createDataFrame(rows, f"i int, base {span}, more {span}")
    got = {r.i: [tuple(x) for x in r.found] for r in df.select("i", pii.without_overlaps(pii.F.col("base"), pii.F.col("more")).alias("found")).collect()}
    for i, base, more in rows:
        order = sorted(base + more, key=lambda s: (s[0], -s[2], s[3]))
        kept = []
        for k, s in enumerate(order):
            before = any(o[2] > s[0] for o in order[:k])
            if not s[1] or not before and not any(b[0] < s[2] and s[0] < b[2] for b in base):
                kept.append(s)
        assert sorted(got[i]) == sorted(kept)


def test_running_totals(spark):
    for n in (0, 1, 63, 64, 65, 5000):
        x = [RNG.randrange(-50, 50) for _ in range(n)]
        df = spark.createDataFrame([(x,)], "x array<int>")
        a, b = df.select(pii.running(pii.F.col("x"), pii.add, 0), pii.running(pii.F.col("x"), pii.larger, -100)).first()
        assert a == np.cumsum(x).tolist() and b == (np.maximum.accumulate(x).tolist() if n else [])


def test_personal_data_in_long_texts(spark, docs):
    """Places and masks of very many matches in one text, in time that grows with its length."""
    unit = "a@b.co 12 34 \U0001f600 (212) 555-0100 ssn 123-45-6789 "
    rows = [(1, unit * 4000), (2, "12 a " * 100_000)]
    got = {r.doc_id: r for r in pii.find_personal_data(docs(rows)).collect()}
    assert got[1].base_sha256 == hashlib.sha256(",".join(brute.personal(rows[0][1])).encode()).hexdigest() and got[1].n_email == 4000
    spans = [x.split(":") for x in got[1].spans.split(",")]
    assert all(rows[0][1][int(a) : int(b)] in ("a@b.co", "(212) 555-0100", "123-45-6789") for _, a, b in spans)
    masked = {r.doc_id: r.text for r in pii.mask(docs(rows).selectExpr("*", "1 AS found", "2 AS cands", "3 AS __base", "4 AS spans", "5 AS plain")).collect()}
    assert masked[1].count("<EMAIL>") == 4000 and "@" not in masked[1] and masked[1].count("\U0001f600") == 4000 and masked[2] == rows[1][1]


def test_reliabilities():
    rows = [(0, (1, 1, 1, 1), 900), (0, (0, 0, -1, 0), 500), (1, (-1, 1, 1, 1), 30), (1, (-1, 0, -1, 0), 40)]
    p = pii.reliabilities(rows)
    assert p[0] > 0.9 > 0.1 > p[1] and p[2] > 0.5 > p[3]


def test_language(spark):
    rows, rng = [], random.Random(3)
    for i in range(240):
        lang = ("aa", "bb", "cc")[i % 3]
        letters = {"aa": "aeioulm", "bb": "zxkvrt", "cc": "éèàçñ"}[lang]
        rows.append((i, " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 6))) for _ in range(rng.randint(5, 90))), lang if i % 10 else None, "s", 0))
    rows += [(900, None, "aa", "s", 0), (901, "123 ...", "aa", "s", 0), (902, "", None, None, 0), (None, "aeiou lima", "aa", "s", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = langid.identify(df.selectExpr("*", "1 AS held_out", "2 AS score")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    held = [i for i in range(240) if by[i].held_out]
    assert held and all(by[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(240))
    assert sum(by[i].lang_pred == ("aa", "bb", "cc")[i % 3] for i in held) / len(held) > 0.95
    assert all((by[i].lang_pred, by[i].score) == ("und", 0.0) for i in (900, 901, 902)) and all(0 <= r.score <= 1 for r in got)
    clashing = df.selectExpr("*", "1 AS __pred", "2 AS held_out", "3 AS lettered", "4 AS __text")
    kept = langid.keep_identified(clashing)
    assert kept.dtypes == clashing.dtypes and kept.count() == 241
    assert langid.keep_identified(df, least=float("inf")).count() == 241  # no odds reach the limit
    bare = df.drop("lang").selectExpr("*", "cast(null as string) AS lang")
    assert langid.keep_identified(bare).count() == 241  # nothing is known of languages: all with letters stay
    assert {r.lang_pred for r in langid.identify(df.drop("lang").selectExpr("*", "cast(null as string) AS lang")).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_elias_fano():
    rng = np.random.default_rng(1)
    for universe in (1, 10, 1000, 2**40, 2**48):
        v = np.unique(rng.integers(0, universe, 500).astype(np.uint64))
        e = language_model.EliasFano.view(*language_model.EliasFano.of(v, universe).columns())
        q = rng.integers(0, universe, 500).astype(np.uint64)
        assert (e.find(v) == np.arange(len(v))).all() and ((e.find(q) >= 0) == np.isin(q, v)).all()


@pytest.mark.parametrize("top", [1_000_000, 20])
def test_scoring(spark, docs, top):
    rng = random.Random(1)
    rows = []
    for i in range(200):  # each word has a few likely followers
        at, text = rng.randrange(400), []
        for _ in range(rng.randrange(1, 60)):
            text.append(VOCABULARY[at])
            at = (at * 7 + rng.choice([1, 1, 1, 2, 3])) % 400 if rng.random() < 0.9 else rng.randrange(400)
        rows.append((i, " ".join(text)))
    rows += ODD
    got = language_model.score(docs(rows, extra=True), top).collect()
    assert len(got) == len(rows)
    tokens = [(i, [*brute.words(t), None]) for i, t in rows]
    c = collections.Counter(w for i, ws in tokens if brute.in_training(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = collections.defaultdict(list)
    for i, ws in tokens:
        want[i].append((len(ws), sum(c[w] > 0 for w in ws), not brute.in_training(i), sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws)))
    for r in got:
        size, known, held, base = want[r.doc_id][0]
        assert (r.n_tokens, r.n_known, r.held_out, r.train_tokens) == (size, known, held, n)
        assert r.base_score == pytest.approx(base) and r.score <= 0
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_are_those_of_all_counts(spark, docs, monkeypatch):
    """Against plain counts, less what quantising takes; the same for any number of shards and any size of the table."""
    rng = random.Random(8)
    rows = [(i, " ".join(VOCABULARY[min(int(rng.paretovariate(0.6)), 399)] for _ in range(rng.randrange(1, 80)))) for i in range(150)] + ODD
    uni, pair, after = collections.Counter(), collections.Counter(), collections.Counter()
    streams = [(i, [0, *brute.words(t), 1]) for i, t in rows]
    for i, s in streams:
        if brute.in_training(i):
            uni.update(s[1:]), pair.update(zip(s, s[1:], strict=False)), after.update(s[:-1])
    kinds, n = collections.Counter(v for v, _ in pair), sum(uni.values())
    once, twice = (sum(c == k for c in pair.values()) for k in (1, 2))
    d = min(0.95, max(0.5, once / (once + 2 * twice)))
    first = lambda w: (uni[w] - 0.8) / n if uni[w] else 0.8 * len(uni) / n
    prob = lambda v, w: max(pair[v, w] - d, 0) / after[v] + d * kinds[v] / after[v] * first(w) if after[v] else first(w)
    want = {i: sum(math.log10(min(1, prob(v, w))) for v, w in zip(s, s[1:], strict=False)) for i, s in streams}
    found, before = [], spark.conf.get("spark.sql.shuffle.partitions")
    for shards, top in ((1, 1_000_000), (7, 1_000_000), (7, 20), (3, 0)):
        try:
            spark.conf.set("spark.sql.shuffle.partitions", str(shards))
            found.append({r.doc_id: r.score for r in language_model.score(docs(rows), top).collect()})
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
    for i, s in streams:
        assert want[i] - 0.04 * len(s) <= found[0][i] <= want[i] + 1e-6
        assert all(f[i] == pytest.approx(found[0][i], abs=1e-9) for f in found)


@pytest.mark.parametrize("sizes", [[70_000], [59_000, 9_000], [130_000, 3]])
def test_blocks_number_their_documents_in_16_bits(sizes):
    made = [pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array(["", None, "one two"] * (n // 3) + [""] * (n % 3))], names=["doc_id", "text"]) for n in sizes]
    got = list(language_model.blocks(iter(made)))
    assert sum((list(ids) for _, ids, _, _, _ in got), []) == [i for n in sizes for i in range(n)]
    assert len({b for b, *_ in got}) == len(got)
    for _, ids, v, w, d in got:
        assert len(v) == len(w) == len(d) and d.max() == len(ids) - 1 < 2**16 and (np.unique(d) == np.arange(len(ids))).all()


def test_probabilities_sum_to_one_at_most():
    """Of every first word, over all words of a small vocabulary and the unknown ones."""
    texts = [" ".join(RNG.choice(VOCABULARY[:12]) for _ in range(30)) for _ in range(20)]
    h = [[language_model.START, *map(np.uint64, map(words.hash_word, t.split())), language_model.END] for t in texts]
    counts = collections.Counter(w for s in h for w in s[1:])
    plan = language_model.Plan(sum(counts.values()), len(counts), np.asarray(list(counts), np.uint64).view(np.int64), np.asarray(list(counts.values())), 1)

    class Shared:
        value = plan

    plan.hot = plan.hot[:0]
    batch = pa.RecordBatch.from_arrays([pa.array([d for d in range(200) if brute.in_training(d)][:20]), pa.array(texts)], names=["doc_id", "text"])
    table = next(language_model.sent(iter([batch]), Shared))
    trie = language_model.Trie(table.to_pylist(), plan.hot, plan.hot, 1)
    every = np.asarray([*counts, np.uint64(77)], np.uint64)
    p1 = plan.unigram.levels[plan.unigram_codes(every)]
    assert p1.sum() <= 1 + 1e-9
    for v in every:
        _, p = trie.ask(np.full(len(every), v & language_model.FIRST_MASK), every & language_model.SECOND_MASK, p1)
        assert 0.9 < p.sum() <= 1 + 1e-9 or v == 77 or v == language_model.END


PAGE = """<!DOCTYPE html><html><head><title>T {0}</title><script>var a="</p>";</script></head><body><header class="site-header">Site</header><nav><ul><li><a href="/a">Menu {0}</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><aside class="sidebar">Side {0}</aside><{1}><h1>Title&nbsp;{0} &amp; more</h1><p>First <b>bold</b> line {0}<br>after<p>Second &lt;tag&gt; {0}
 wrapped</p><form>Name <input></form><div class="ad banner">Buy {0}</div><div class="comments"><p>Reader {0}</p></div></{2}><footer>Foot</footer></body>"""


@pytest.mark.parametrize("box", [("article", "article"), ('div class="post-body"', "div"), ("main", "main")])
def test_extraction(spark, box):
    rows = [(i, f"http://h{i % 2}.example.com/p{i}", PAGE.format(i, *box)) for i in range(12)]
    rows += [(100, None, None), (101, "odd", ""), (102, "http://x.y/", "just text &eacute; here"), (103, "http://h0.example.com/z", "<p>alone</p>"), (0, "http://h0.example.com/p0", PAGE.format(0, *box)), (104, "u", "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS host", "'w' AS wrapper")
    got = extraction.extract(df).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i in range(12):
        assert by[i].text == f"Title {i} & more\nFirst bold line {i} after\nSecond <tag> {i} wrapped" and by[i].wrapped
    assert [by[i].text for i in (100, 101, 102, 103, 104)] == ["", "", "just text é here", "alone", "deep"] and all(r.n_chars == len(r.text) for r in got)


def test_wrapper_is_an_expression():
    w = extraction.infer([PAGE.format(i, "article", "article") for i in range(4)])
    assert w["region"][-1] == "article" and w["slots"] >= 3 and "#slot" in w["expression"]
    items = [(k, n, None, (), False) for k, n in [("<", "li"), ("#", ""), (">", "li")] * 5]
    assert [x[0] for x in extraction.folded(items)] == ["+"]
    json.dumps(w)


def test_pages_are_matched_with_their_wrapper(spark):
    """Texts of the template at the region's ends go, at any length of the page; slots, groups and what lies between stay."""
    page = "<html><body><div class='post'>" + "".join("<h2>Part {0} %d</h2><p>Own {0} %d</p><ul><li>x</li></ul>" % (i, i) + "<hr>" * (i % 3) for i in range(900)) + "<h4>Kept heading</h4><h5>Tail {0}</h5><h6>Posted by the staff</h6></div></body></html>"
    df = spark.createDataFrame([(i, f"http://h.example.com/p{i}", page.format(i)) for i in range(8)], "page_id long, url string, html string")
    for r in extraction.extract(df).collect():
        lines = r.text.split("\n")
        assert r.wrapped and lines[0] == f"Part {r.page_id} 0" and lines[-1] == f"Tail {r.page_id}" and len(lines) > 1800
        assert "Posted by the staff" not in lines and lines[-2] == "Kept heading"  # between own texts it is the article's


def test_extraction_of_odd_markup(spark, monkeypatch):
    pages = ['<p>one <a title="foo>bar</a> two</p>', '<p>one <a title="foo>bar</a> two <b class="x">three</b></p>', "<p title='a > b'>t</p>", "<div>" * 8000 + "deep", "<b>" * 8000 + "<p>x" * 3, "</i>" * 50_000 + "y"]
    df = spark.createDataFrame([(i, f"http://h{i}.com/", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    wanted = {0: "one bar two", 1: "one bar two three", 2: "t", 3: "deep", 4: "x\nx\nx", 5: "y"}
    assert {r.page_id: r.text for r in extraction.extract(df).collect()} == wanted
    monkeypatch.setattr(extraction, "SENT", 0)  # wrappers beyond the bound of what all tasks get
    assert {r.page_id: r.text for r in extraction.extract(df).collect()} == wanted


def test_common_subsequence(monkeypatch):
    rng = random.Random(3)
    for limit in (1, 50, 10**6):
        monkeypatch.setattr(extraction, "TABLE", limit)
        for _ in range(60):
            a, b = ([rng.choice("abcd") for _ in range(rng.randrange(30))] for _ in range(2))
            best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
            pairs = extraction.common(a, b)
            assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
            assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:], strict=False))


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 16)).astype(np.float32)
    x[5] = x[100]
    rows = [(i, [float(v) for v in x[i]]) for i in range(900)]
    rows += [(1000, None), (1100, [0.0] * 16), (1200, [float("nan")] + [1.0] * 15), (1300, [None] + [1.0] * 15), (1400, [1.0]), (1500, [float("inf")] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "0 AS rank", "1 AS score")
    got = neighbours.nearest(df, spread=3).collect()
    x = x.astype(np.float64)
    for q in range(0, 900, 100):
        d = neighbours.exact(np.repeat(x[q : q + 1], 900, 0), x)
        order = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert own == [(k + 1, i, d[i]) for k, i in enumerate(order)]
    assert {r.query_id for r in got} == set(range(0, 900, 100))
    few = neighbours.nearest(spark.createDataFrame(rows[:4], "vec_id long, embedding array<float>")).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_neighbours_of_a_table_read_twice(spark):
    """Query blocks of different tasks that begin with the same id are blocks of their own."""
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(0, 60)]
    first = [(0, rows[0][1]), *[(100 + i, v) for i, v in rows[1:30]]]
    second = [(0, rows[0][1]), *[(200 + i, v) for i, v in rows[30:]]]
    make = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<double>").coalesce(1)
    got = neighbours.nearest(make(first).union(make(second)), k=5, every=1, spread=3).collect()
    every = first + second
    ids, x = np.asarray([i for i, _ in every]), np.asarray([v for _, v in every])
    assert {r.query_id for r in got} == set(ids.tolist())
    for i, v in [*first[1:], *second[1:]]:
        d = neighbours.exact(np.repeat([v], len(x), 0), x)
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:5]
        assert sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == i) == [(k + 1, ids[j], d[j]) for k, j in enumerate(order)]


def test_tile_bounds_hold():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(40, 64)), rng.normal(size=(60, 64)) * rng.uniform(0.01, 100, (60, 1))
    low, high = neighbours.tile_bounds(neighbours.quantised(a), neighbours.quantised(b))
    d = np.linalg.norm(a[:, None] - b[None], axis=2)
    assert (low <= d).all() and (d <= high).all()


def test_licences(spark):
    rows = [
        ("r/LICENSE", "Released under the MIT License"), ("r/a/b/x.py", "code"), ("r/a/LICENSE.txt", "Licensed under the Apache License, Version 2.0"), ("r/a/b/c/y.py", "no\n# Licensed under CC BY-NC 4.0.\nend"),
        ("r/z.py", None), ("q/z.py", "x"), (None, "Released under the MIT License."), ("q/z.py", "x"), ("top", ""), ("r/a/b/long.py", "w " * 50_000),
    ]
    df = spark.createDataFrame(rows, "path string, text string").selectExpr("*", "1 AS licence", "2 AS dir")
    got = sorted((str(r.path), r.own_licence, r.licence, r.inherited_from) for r in licences.scan(df).collect())
    assert got == sorted([
        ("r/LICENSE", "MIT", "MIT", None), ("r/a/b/x.py", None, "Apache-2.0", "r/a"), ("r/a/LICENSE.txt", "Apache-2.0", "Apache-2.0", None), ("r/a/b/c/y.py", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
        ("r/z.py", None, "MIT", "r"), ("q/z.py", None, None, None), ("None", "MIT", "MIT", None), ("q/z.py", None, None, None), ("top", None, None, None), ("r/a/b/long.py", None, "Apache-2.0", "r/a"),
    ], key=str)
    assert licences.scan(df.limit(0)).count() == 0


def test_licences_of_several_lines(spark):
    wrapped = lambda t, n=60, p="": "\n".join(p + " ".join(t.split()[i : i + n // 6]) for i in range(0, len(t.split()), n // 6))
    mit, gpl, apache = licences.TEXTS["MIT"], licences.TEXTS["GPL-3.0"], licences.TEXTS["Apache-2.0"]
    rows = [
        ("m/LICENSE", "Copyright (c) 2020 Somebody\n\n" + wrapped(mit)), ("m/x.py", "code"), ("g/y.c", "/* Copyright (C) 2019 Some Body\n" + wrapped(gpl, 72, " * ") + " */\nint main;"),
        ("a/z.java", wrapped(apache, 72, "// ") + "\n" + "class A { }\n" * 40), ("t/w.rs", "// SPDX-License-Identifier: BSD-3-Clause\nfn main"), ("t/v.rs", "licence talk only"),
    ]
    got = {r.path: r.licence for r in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect()}
    assert got == {"m/LICENSE": "MIT", "m/x.py": "MIT", "g/y.c": "GPL-3.0", "a/z.java": "Apache-2.0", "t/w.rs": "BSD-3-Clause", "t/v.rs": None}
