"""Personal data by weak supervision: labelers vote on candidate spans, expectation-maximisation estimates how reliable
they are, and a span classifier trained on its posteriors decides. DataFrame functions only.

Candidates are the matches of the base patterns (with those that fail a base check, as negative material) and of wider
patterns: numbers with a phone's grouping but no plus, spelt-out mail addresses, secrets in assignments, social security
numbers, IBANs. Labelers: the strict pattern and its check (regex), lists of top-level domains, calling codes, issuers
and address ranges (gazetteer), words before the span (context), and what touches it (edge). Each votes 1, 0 or
abstains (-1). Votes are counted by kind and pattern over all documents, and expectation-maximisation turns them into a
posterior for each candidate.

The classifier reads what no labeler sees: the shape of the match and the words left and right of it, each hashed into
BUCKETS. Posteriors are summed by pattern, feature and bucket over all documents; a bucket's evidence is its log odds
against its pattern's, drawn towards none where few candidates fell into it. A logistic model without votes, fitted to
the posteriors over rounded evidence, weighs the three features. A span's chance adds this evidence to the labelers'
log odds, so that a word which often stands before confirmed spans speaks for the unconfirmed ones after it. All that
reaches the driver are counts by votes (hundreds of rows), sums by bucket and counts by rounded evidence (thousands),
whatever the input's size; the classifier is then a Column expression. Base spans always stay. Accepted others are added unless they overlap a base span or begin within
another that begins before them (of those that begin together, the longer stands, then the earlier kind).

Patterns are possessive, and start where a run of their first characters starts, so no text makes them backtrack far.
Places and overlaps come from running totals over a text's matches (``running``), so work grows with the text's length,
not with its square.

Defined cases: a null text is empty; a document without spans has the digest of the empty string and an empty list;
rows repeat as often as in the input; a null doc_id is kept as null; an empty table gives an empty result; other
columns are left out (``mask`` keeps them). Positions count code points.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.llm.shared import cut, fresh

BASE_KINDS = ["email", "ip", "card", "phone"]
KINDS = [*BASE_KINDS, "secret", "ssn", "iban"]
LOCAL = "A-Za-z0-9._%+-"
#: name -> (kind, pattern, a text without it has no match)
SOURCES: dict[str, tuple[str, str, str]] = {
    "email": ("email", rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("ip", r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}", "."),
    "card": ("card", r"[0-9](?:[\x20-]?+[0-9])++", ""),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "email_spelt": ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:\[at\]|\(at\)|\{at\})\x20?[A-Za-z0-9-]{1,63}+(?:\x20?(?:\[dot\]|\(dot\)|\{dot\}|\.)\x20?[A-Za-z0-9-]{1,63}+){1,4}", "at"),
    "phone_plain": ("phone", r"(?<![0-9A-Za-z+.(-])(?:\([0-9]{2,4}\)\x20?|[0-9]{2,4}[\x20.-])[0-9]{3,4}[\x20.-][0-9]{3,4}(?![0-9A-Za-z])", ""),
    "secret": ("secret", r"(?i)(?<![a-z])(?:token|api[_-]?key|secret|passw(?:or)?d)\x20?[:=]\x20?[\"'][A-Za-z0-9_/+=.-]{8,}+[\"']", "="),
    "ssn": ("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "-"),
    "iban": ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", ""),
}
TLDS = "com org net edu gov io co info biz dev app ai me tv uk de fr es it nl eu us ca au ch at be pl cz se no dk fi pt br in jp cn ru".split()
CALLING = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()
CONTEXT = {
    "email": "mail|contact|write|e-?mail|reach", "ip": r"\bip\b|host|server|addr", "card": "card|visa|credit|debit|pay", "phone": "phone|tel|call|fax|mobile|cell|dial",
    "secret": "key|auth|log ?in|config|export|credential|env|bearer|header", "ssn": "ssn|social|security", "iban": "iban|bank|account",
}
#: Words before values that only stand for a secret.
INVENTED = "example|sample|placeholder|dummy|fake|your"
LABELERS = ["regex", "gazetteer", "context", "edge"]
#: Labelers whose abstentions are no evidence, and the largest log odds of each labeler's vote: words beside a span
#: must not outweigh a failed check.
SILENT, BELIEF = ["regex", "gazetteer"], {"regex": 6.0, "gazetteer": 3.0, "context": 3.0, "edge": 3.0}
#: What the classifier reads of a candidate, and the buckets of each.
FEATURES, BUCKETS = ["shape", "left", "right"], 256
#: Candidates' worth of its pattern's odds that each bucket is given, and the largest evidence either way.
PRIOR, MOST = 4.0, 4


#: Items in a stride of an array: running totals are taken within strides and over the strides' totals.
STRIDE = 64
Op = Callable[[Column, Column], Column]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def strides(items: Column) -> Column:
    """The array cut into arrays of STRIDE items."""
    starts = lambda xs: F.sequence(F.lit(0), F.greatest(F.size(xs) - 1, F.lit(0)), F.lit(STRIDE))
    return let(items, lambda xs: F.transform(starts(xs), lambda i: F.slice(xs, i + 1, F.lit(STRIDE))))


def running(numbers: Column, op: Op, zero: int, levels: int = 2) -> Column:
    """op over all items up to each, of an array of integers. A fold that appends to an array copies all it has at every
    item; here each item folds its stride alone, from what the strides before it gave (taken in the same way)."""
    up_to = lambda xs, first: F.transform(F.sequence(F.lit(1), F.size(xs)), lambda k: F.aggregate(F.slice(xs, F.lit(1), k), first, op))
    any_ = lambda xs, first: F.when(F.size(xs) > 0, up_to(xs, first)).otherwise(F.array().cast("array<int>"))
    if not levels:
        return let(numbers, lambda xs: any_(xs, F.lit(zero)))

    def joined_up(blocks: Column) -> Column:
        totals = F.transform(blocks, lambda b: F.aggregate(b, F.lit(zero), op))
        return let(running(totals, op, zero, levels - 1), lambda run: F.flatten(F.transform(blocks, lambda b, i: any_(b, before(run, i, zero)))))

    return let(strides(numbers), joined_up)


def before(run: Column, i: Column, zero: int) -> Column:
    return F.when(i > 0, F.get(run, i - 1)).otherwise(F.lit(zero))


def add(a: Column, b: Column) -> Column:
    return a + b


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    back = F.reverse(digits)
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)),
        F.lit(0),
        lambda acc, i: acc + F.when(i % 2 == 1, F.substr(back, i, F.lit(1)).cast("int")).otherwise(F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), F.substr(back, i, F.lit(1)).cast("int") + 1)),
    )
    return total % 10 == 0


def base_check(source: str, m: Column) -> Column:
    """Whether a match of a base pattern counts."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    if source == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+(?=[0-9])", "").try_cast("int") <= 255, F.lit(False)))
    if source == "card":
        return F.when(F.length(digits).between(13, 19), luhn(digits)).otherwise(False)
    if source == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(source == "email")


def votes(source: str, kind: str, m: Column, left: Column, right: Column) -> dict[str, Column]:
    digits = F.regexp_replace(m, "[^0-9]", "")
    known = {
        "email": F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)).isin(TLDS),
        "ip": F.coalesce(F.split(m, r"\.")[0].try_cast("int").between(1, 223), F.lit(False)),
        "card": digits.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"),
        "phone": F.lit(None).cast("boolean") if source == "phone_plain" else F.substring(digits, 1, 1).isin([c for c in CALLING if len(c) == 1]) | F.substring(digits, 1, 2).isin([c for c in CALLING if len(c) == 2]),
        "secret": m.rlike("[0-9]") & m.rlike("[A-Za-z]"),
        "ssn": ~m.rlike("^(?:000|666|9)"),
        "iban": F.length(F.regexp_replace(m, " ", "")).between(15, 34),
    }[kind]
    said = F.when(F.lower(left).rlike(CONTEXT[kind]), 1).otherwise(-1)
    if kind == "secret":  # the name that is assigned to is a context of its own
        said = F.when(F.lower(left).rlike(INVENTED), 0).when(m.contains("="), 1).otherwise(said)
    touched = F.substring(left, -1, 1).rlike("[A-Za-z0-9]") | F.substring(right, 1, 1).rlike("[A-Za-z0-9]")
    return {
        "regex": F.when(base_check(source, m), 1).otherwise(0) if source in BASE_KINDS else F.lit(-1),
        "gazetteer": F.coalesce(F.when(known, 1).otherwise(F.when(known.isNull(), -1).otherwise(0)), F.lit(-1)),
        "context": said,
        "edge": F.when(touched, 0).otherwise(1),
    }


def traits(m: Column, left: Column, right: Column) -> dict[str, Column]:
    """The FEATURES of a match as buckets: letters and digits of the match by place, and its neighbour words."""
    shape = F.regexp_replace(F.regexp_replace(m, r"\p{L}+", "a"), "[0-9]", "9")
    words = {"left": F.regexp_extract(F.lower(left), r"(\p{L}+)\P{L}*$", 1), "right": F.regexp_extract(F.lower(right), r"^\P{L}*(\p{L}+)", 1)}
    return {k: F.pmod(F.xxhash64(v), F.lit(BUCKETS)) for k, v in {"shape": shape, **words}.items()}


CANDIDATES = f"array<struct<kind:int,source:int,start:int,stop:int,base:boolean,{','.join(f'{k}:int' for k in [*LABELERS, *FEATURES])}>>"


def voter(source: str, kind: str):
    """A match as a candidate of the source, with its votes and features."""

    def vote(x: Column) -> Column:
        v = votes(source, kind, x["m"], x["l"], x["r"]) | traits(x["m"], x["l"], x["r"])
        base = base_check(source, x["m"]) if source in BASE_KINDS else F.lit(False)
        place = [F.lit(KINDS.index(kind)).alias("kind"), F.lit(list(SOURCES).index(source)).alias("source"), x["start"].alias("start"), x["stop"].alias("stop")]
        return F.struct(*place, base.alias("base"), *[v[k].cast("int").alias(k) for k in [*LABELERS, *FEATURES]])

    return vote


def candidates(docs: DataFrame, text: str, keep: list[str], name: str) -> DataFrame:
    """``keep`` columns and ``name``: an array of (kind index, start, end, base, votes) of each row's ``text`` column."""
    at = {source: fresh([*docs.columns, name], source) for source in SOURCES}
    df = docs.withColumns({at[s]: F.col(text).rlike(pattern) if not needed else F.col(text).contains(needed) & F.col(text).rlike(pattern) for s, (_, pattern, needed) in SOURCES.items()})
    # matches, and the stretches between them
    both = lambda pattern: F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("b"))
    df = df.withColumns({at[s]: F.when(F.col(at[s]), both(pattern)) for s, (_, pattern, _) in SOURCES.items()})

    def located(parts: Column) -> Column:
        sizes = F.transform(parts, lambda x: F.length(x["l"]) + F.length(x["m"]))
        return F.zip_with(parts, running(sizes, add, 0), lambda x, end: F.struct(x["m"].alias("m"), F.substring(x["l"], -30, 30).alias("l"), F.substring(x["r"], 1, 20).alias("r"), (end - F.length(x["m"])).alias("start"), end.alias("stop")))

    digits = lambda x: F.length(F.regexp_replace(x["m"], "[^0-9]", ""))
    lists = []
    for source, (kind, _, _) in SOURCES.items():
        m, b = F.col(at[source])["m"], F.col(at[source])["b"]
        found = let(F.arrays_zip(m.alias("m"), F.slice(b, 1, F.size(m)).alias("l"), F.slice(b, 2, F.size(m)).alias("r")), located)
        if source == "card":
            found = F.filter(found, lambda x: digits(x) >= 9)
        if source == "phone_plain":
            found = F.filter(found, lambda x: digits(x).between(9, 15))
        lists.append(F.coalesce(F.when(m.isNotNull(), F.transform(found, voter(source, kind))).cast(CANDIDATES), F.array().cast(CANDIDATES)))
    return df.select(*keep, F.concat(*lists).alias(name))


def vote_weights(rows: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Log odds by kind, and by labeler and vote (-1, 0, 1), from (kind, votes, count) rows: two-class
    expectation-maximisation with a prior for each kind and the chances of a labeler's votes given the class; add-one
    smoothing. Regex and gazetteer abstain where a pattern has no check or list, which says nothing of the span, so that
    their abstentions count for neither class. No vote moves the log odds by more than BELIEF says."""
    if not rows:
        return np.zeros(len(KINDS)), np.zeros((len(LABELERS), 3))
    kinds = np.asarray([r[0] for r in rows])
    vote = np.asarray([r[1] for r in rows]) + 1
    count = np.asarray([r[2] for r in rows], float)
    most = np.asarray([[BELIEF[k]] for k in LABELERS])
    p = ((vote == 2).sum(1) + 0.5) / ((vote == 2).sum(1) + (vote == 1).sum(1) + 1.0)
    for _ in range(rounds):
        prior, said = np.zeros((2, len(KINDS))), np.zeros((2, vote.shape[1], 3))
        for c, w in enumerate((count * (1 - p), count * p)):
            prior[c] = np.log(np.bincount(kinds, weights=w, minlength=len(KINDS)) + 1.0)
            for k in range(vote.shape[1]):
                share = np.bincount(vote[:, k], weights=w, minlength=3) + 1.0
                if LABELERS[k] in SILENT:
                    said[c, k, 1:] = np.log(share[1:] / share[1:].sum())
                else:
                    said[c, k] = np.log(share / share.sum())
        by_kind, by_vote = prior[1] - prior[0], np.clip(said[1] - said[0], -most, most)
        p = logistic(by_kind[kinds] + by_vote[np.arange(vote.shape[1]), vote].sum(1))
    return by_kind, by_vote


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def reliabilities(rows: list[tuple[int, tuple[int, ...], int]], rounds: int = 50) -> np.ndarray:
    """Posterior of each (kind, votes, count) row being personal data."""
    by_kind, by_vote = vote_weights(rows, rounds)
    return logistic(np.asarray([by_kind[k] + sum(by_vote[i, v + 1] for i, v in enumerate(vote)) for k, vote, _ in rows]))


def listed(values: np.ndarray) -> Column:
    """Numbers as one array literal."""
    return F.split(F.lit(",".join(f"{float(v):.6f}" for v in values.ravel())), ",").cast("array<double>")


def vote_odds(c: Column, by_kind: np.ndarray, by_vote: np.ndarray) -> Column:
    """The labelers' log odds of a candidate."""
    z = F.get(listed(by_kind), c["kind"])
    for name, odds in zip(LABELERS, by_vote, strict=True):
        z = z + F.get(listed(odds), c[name] + 1)
    return z


def chance(z: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(50.0)), F.lit(-50.0))))


def evidence(sums: list[tuple[int, int, int, float, int]]) -> np.ndarray:
    """[feature, source, bucket] from (source, feature, bucket, sum of posteriors, count) rows."""
    yes, n = np.zeros((len(FEATURES), len(SOURCES), BUCKETS)), np.zeros((len(FEATURES), len(SOURCES), BUCKETS))
    for source, f, bucket, p, count in sums:
        yes[f, source, bucket], n[f, source, bucket] = p, count
    share = (yes.sum(2, keepdims=True) + 0.5) / (n.sum(2, keepdims=True) + 1.0)
    odds = np.log((yes + PRIOR * share) / (np.maximum(n - yes, 0.0) + PRIOR * (1 - share))) - np.log(share / (1 - share))
    return np.clip(odds, -MOST, MOST)


def slopes(rows: list[tuple[int, tuple[int, ...], float, int]]) -> list[float]:
    """Weights (0 to 1) of the FEATURES' evidence in a logistic model with a constant for each source, fitted to the mean
    posteriors of (source, evidence, sum of posteriors, count) rows by Newton steps with a small ridge."""
    if not rows:
        return [0.0] * len(FEATURES)
    x = np.asarray([[*[float(s == i) for i in range(len(SOURCES))], *map(float, e)] for s, e, _, _ in rows])
    n = np.asarray([r[3] for r in rows], float)
    p = np.asarray([r[2] for r in rows]) / n
    n = n / n.sum() * len(rows)
    w = np.zeros(x.shape[1])
    for _ in range(30):
        q = logistic(x @ w)
        grad = x.T @ (n * (q - p)) + 0.05 * w
        w -= np.linalg.solve((x * (n * q * (1 - q))[:, None]).T @ x + 0.05 * np.eye(len(w)), grad)
    return [float(min(max(v, 0.0), 1.0)) if math.isfinite(v) else 0.0 for v in w[len(SOURCES) :]]


def classifier(rows: DataFrame, name: str) -> Callable[[Column], Column]:
    """The chance of a candidate being personal data, learnt from all candidates in the column ``name``."""
    found = rows.select(F.explode(name).alias("c"))
    counted = found.groupBy("c.kind", *[f"c.{k}" for k in LABELERS]).count().collect()
    weights = vote_weights(sorted((r[0], tuple(r[1:-1]), r[-1]) for r in counted))
    # in millionths, so that sums do not depend on the order of rows
    share = F.round(chance(vote_odds(F.col("c"), *weights)) * 1_000_000).cast("long").alias("p")
    marks = F.array(*[F.struct(F.lit(i).alias("feature"), F.col(f"c.{k}").alias("bucket")) for i, k in enumerate(FEATURES)])
    summed = found.select("c.source", share, F.explode(marks).alias("f")).groupBy("source", "f.feature", "f.bucket").agg(F.sum("p"), F.count("*"))
    tables = evidence([(r[0], r[1], r[2], r[3] / 1e6, r[4]) for r in summed.collect()])
    told = lambda c: [F.get(listed(t), c["source"] * BUCKETS + c[k]) for k, t in zip(FEATURES, tables, strict=True)]
    level = [F.round(e).cast("int").alias(k) for k, e in zip(FEATURES, told(F.col("c")), strict=True)]
    levels = found.select("c.source", *level, share).groupBy("source", *FEATURES).agg(F.sum("p"), F.count("*"))
    by = slopes(sorted((r[0], tuple(r[1:-2]), r[-2] / 1e6, r[-1]) for r in levels.collect()))

    def decide(c: Column) -> Column:
        z = vote_odds(c, *weights)
        for slope, e in zip(by, told(c), strict=True):
            z = z + F.lit(slope) * e
        return chance(z)

    return decide


def without_overlaps(base: Column, more: Column) -> Column:
    """Base and added spans in order of place (the longer first), without the added ones that begin within another
    before them or meet a base span."""
    last = 2**31 - 1
    sorted_ = F.array_sort(F.concat(base, more), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).when(a["stop"] != b["stop"], b["stop"] - a["stop"]).otherwise(a["kind"] - b["kind"]))

    def cleared(xs: Column) -> Column:
        ends = running(F.transform(xs, lambda x: x["stop"]), larger, 0)
        base_ends = running(F.transform(xs, lambda x: F.when(x["added"], 0).otherwise(x["stop"])), larger, 0)
        begins = F.reverse(running(F.reverse(F.transform(xs, lambda x: F.when(x["added"], last).otherwise(x["start"]))), smaller, last))
        free = lambda x, i, e: (x["start"] >= before(e["ends"], i, 0)) & (x["start"] >= F.get(e["base"], i)) & (x["stop"] <= F.get(e["begins"], i))
        known = F.struct(ends.alias("ends"), base_ends.alias("base"), begins.alias("begins"))
        return let(known, lambda e: F.filter(xs, lambda x, i: ~x["added"] | free(x, i, e)))

    return let(sorted_, cleared)


def decided(docs: DataFrame, text: str, keep: list[str], name: str, threshold: float = 0.5) -> DataFrame:
    """``keep`` columns and ``name``: sorted array of (kind, start, stop, base) of all accepted spans of ``text``."""
    rows = cut(candidates(docs, text, keep, name))
    decide = classifier(rows, name)
    slim = lambda c: F.struct(c["start"].alias("start"), (~c["base"]).alias("added"), c["stop"].alias("stop"), c["kind"].alias("kind"))
    base = F.transform(F.filter(name, lambda c: c["base"]), slim)
    more = F.transform(F.filter(name, lambda c: ~c["base"] & (decide(c) >= threshold)), slim)
    named = lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"), (~x["added"]).alias("base"))
    two = rows.select(*keep, F.struct(base.alias("base"), more.alias("more")).alias(name))
    b, m = F.col(name)["base"], F.col(name)["more"]
    return two.withColumn(name, F.array_sort(F.transform(F.when(F.size(m) > 0, without_overlaps(b, m)).otherwise(b), named)))


def of_kind(i: int):
    return lambda c: c["base"] & (c["kind"] == i)


def joined(found: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda c: F.concat_ws(":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["stop"].cast("string"))), ",")


def find_personal_data(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added, n_spans of every document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = decided(rows, "text", ["doc_id"], "found", threshold)
    base = F.filter("found", lambda c: c["base"])
    counts = [F.size(F.filter("found", of_kind(i))).cast("long").alias(f"n_{k}") for i, k in enumerate(BASE_KINDS)]
    n = F.size("found").cast("long")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"), (n - F.size(base)).alias("n_added"), n.alias("n_spans"))


def masked(text: Column, found: Column) -> Column:
    """The text with each span, or stretch of overlapping spans, replaced by its kind in angle brackets. Stretches of the
    text are taken for a stride of spans first, so that no span is looked for from the text's start."""
    by_place = F.array_sort(F.transform(found, lambda c: F.struct(c["start"].alias("start"), c["stop"].alias("stop"), c["kind"].alias("kind"))))
    ending = F.array(F.struct(F.length(text).alias("start"), F.length(text).alias("stop"), F.lit(len(KINDS)).alias("kind")))

    def parts(xs: Column) -> Column:
        """What stands between the stretches, and the kind after it."""
        part = lambda x, at: F.struct(at.alias("from"), x["start"].alias("to"), x["kind"].alias("kind"))
        ends = running(F.transform(xs, lambda x: x["stop"]), larger, 0)
        return let(ends, lambda e: F.filter(F.transform(xs, lambda x, i: part(x, before(e, i, 0))), lambda p: p["to"] >= p["from"]))

    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit(""))
    own = lambda b: F.struct(b.alias("parts"), b[0]["from"].alias("from"), F.substr(text, b[0]["from"] + 1, F.element_at(b, -1)["to"] - b[0]["from"]).alias("text"))
    one = lambda x, p: F.concat(F.substr(x["text"], p["from"] - x["from"] + 1, p["to"] - p["from"]), F.element_at(names, p["kind"] + 1))
    blocks = F.transform(strides(let(F.concat(by_place, ending), parts)), own)
    return F.array_join(F.transform(blocks, lambda x: F.array_join(F.transform(x["parts"], lambda p: one(x, p)), "")), "")


def mask(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents with their personal data masked; n_chars, where there is such a column, follows the text. A null
    text stays null."""
    plain, spans = fresh(docs.columns, "plain"), fresh(docs.columns, "spans")
    rows = docs.withColumn(plain, F.coalesce(F.col("text").cast("string"), F.lit("")))
    found = decided(rows, plain, docs.columns, spans, threshold)
    text = F.col("text").cast("string")
    out = found.withColumn("text", F.when(F.size(spans) > 0, masked(text, F.col(spans))).otherwise(text)).drop(spans)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
