"""German stems against words of the algorithm's published vocabulary and a plain version."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spindrift.functions import text

KNOWN = {
    "aufeinander": "aufeinand", "aufeinanderfolge": "aufeinanderfolg", "aufeinanderfolgenden": "aufeinanderfolg", "aufeinanderschlügen": "aufeinanderschlug", "auferlegen": "auferleg", "auffallend": "auffall",
    "kategorie": "kategori", "kategorien": "kategori", "kategorisch": "kategor", "kategorischen": "kategor", "kater": "kat", "katze": "katz", "kätzchen": "katzch", "kaufen": "kauf", "käuflich": "kauflich",
    "häuser": "haus", "straße": "strass", "freundlichkeit": "freundlich", "heiligkeit": "heilig", "ergebnisse": "ergebnis", "jahres": "jahr", "bauer": "bau", "neuer": "neu", "ist": "ist", "ob": "ob", "e": "e",
}
VOWELS = set(text.GERMAN_VOWELS)


def plain(word):
    w = list(word.replace("ß", "ss"))
    for letter in "uy":
        i = 1
        while i < len(w) - 1:
            if w[i] == letter and w[i - 1] in VOWELS and w[i + 1] in VOWELS:
                w[i] = letter.upper()
                i += 2
            i += 1
    w = "".join(w)

    def after(start):
        i = start
        while i < len(w) and w[i] not in VOWELS:
            i += 1
        while i < len(w) and w[i] in VOWELS:
            i += 1
        return i + 1 if i < len(w) and i > start and w[i - 1] in VOWELS else None

    one = after(0)
    two = after(one) if one is not None else None
    r1 = len(w) if one is None else max(one, min(3, len(w)))
    r2 = len(w) if two is None else two
    longest = lambda options: max((s for s in options if w.endswith(s)), key=len, default="")
    s = longest(["em", "ern", "er", "e", "en", "es", "s"])
    if s and len(w) - len(s) >= r1 and (s != "s" or w[-2] in text.S_ENDING):
        w = w[: -len(s)]
        if s in ("e", "en", "es") and w.endswith("niss"):
            w = w[:-1]
    s = longest(["en", "er", "est", "st"])
    if s and len(w) - len(s) >= r1 and (s != "st" or len(w) >= 6 and w[-3] in text.ST_ENDING):
        w = w[: -len(s)]
    s = longest(["end", "ung", "ig", "ik", "isch", "lich", "heit", "keit"])
    if s and len(w) - len(s) >= r2:
        rest = w[: -len(s)]
        if s in ("ig", "ik", "isch"):
            w = w if rest.endswith("e") else rest
        elif s in ("end", "ung"):
            w = rest[:-2] if rest.endswith("ig") and not rest.endswith("eig") and len(rest) - 2 >= r2 else rest
        elif s == "keit":
            x = next((x for x in ("lich", "ig") if rest.endswith(x)), "")
            w = rest[: -len(x)] if x and len(rest) - len(x) >= r2 else rest
        else:
            w = rest[:-2] if rest[-2:] in ("er", "en") and len(rest) - 2 >= r1 else rest
    return w.translate(str.maketrans("UYäöü", "uyaou"))


def test_published_words(spark):
    got = spark.createDataFrame([(list(KNOWN),)], "t array<string>").select(text.stem_german(F.col("t")).alias("s")).first()[0]
    assert dict(zip(KNOWN, got, strict=True)) == KNOWN == {w: plain(w) for w in KNOWN}


@pytest.mark.parametrize("seed", [1, 2])
def test_rules_by_a_plain_version(spark, seed):
    rng = random.Random(seed)
    stems = ["b", "ha", "freu", "aue", "kennt", "heil", "lauy", "süd", "straß", "ergebn", "teue", "uy", "ayu"]
    parts = ["ig", "keit", "lich", "heit", "ung", "end", "isch", "ik", "er", "en", "es", "em", "ern", "e", "s", "st", "est", "niss", "eig"]
    words = sorted({rng.choice(stems) + "".join(rng.choice(parts) for _ in range(rng.randint(0, 4))) for _ in range(3000)})
    got = spark.createDataFrame([(words,)], "t array<string>").select(text.stem_german(F.col("t")).alias("s")).first()[0]
    assert [(w, s) for w, s in zip(words, got, strict=True)] == [(w, plain(w)) for w in words]


def test_null_and_empty(spark):
    rows = spark.createDataFrame([(None,), ([],)], "t array<string>").select(text.stem_german(F.col("t")).alias("s")).collect()
    assert [r.s for r in rows] == [None, []]


def test_each_distinct_word_of_a_batch_once():
    arrays = pa.array([["haus", "katzen", None], None, [], ["katzen"] * 5000], pa.list_(pa.string()))
    asked = []
    got = text.by_word(lambda w: asked.append(w) or text.german_stem(w), arrays)
    assert got.to_pylist() == [["haus", "katz", None], None, [], ["katz"] * 5000] and asked == ["haus", "katzen"]
    sliced = text.by_word(text.german_stem, arrays.slice(1, 3))
    assert sliced.to_pylist() == [None, [], ["katz"] * 5000]
