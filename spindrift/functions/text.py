"""Tokens, stop words, bigrams, folding and stemming as columns over strings and string arrays.

Aggressive Czech and German stems are worked out by Arrow functions, once for each distinct word of a batch; all else but
the fold of all marks is a column expression.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters and what they fold to (fixed values, one to one).
ACCENTED = "ÀÁÂÃÄÅČÇĎÈÉÊËÍÌÏÎĹĽŇÑÒÓÔÕÖŔŘŠŤÙÚŮÛŰÜÝŸŽàáâãäåčçďèéêëíìïîĺľňñòóôõöŕřšťùúůûűüýÿž"
PLAIN = "AAAAAACCDEEEEIIIILLNNOOOOORRSTUUUUUUYYZaaaaaaccdeeeeiiiillnnooooorrstuuuuuuyyz"
#: The English stop words of Apache Lucene (fixed values). Other languages' words, and words of web addresses, are parameters.
ENGLISH_WORDS = "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this to was will with".split()


def tokens(column: Column | str, unicode: bool = False, least: int = 2) -> Column:
    """Lower-cased runs of word characters of ``least`` length at least; NULL stays NULL. Without ``unicode`` an
    accented letter separates, as in the tables users have."""
    c = F.lower(F.col(column) if isinstance(column, str) else column)
    return F.filter(F.split(c, r"(?U)[\W_]+" if unicode else r"[\W_]+"), lambda w: F.length(w) >= least)


def without_stop_words(array: Column, words: list[str]) -> Column:
    return F.filter(array, lambda w: ~w.isin(words))


def language_words(language: str) -> list[str]:
    """Spark's own stop words of a language ("english", "german", ...), folded and without repeats. Needs a session."""
    from pyspark.ml.feature import StopWordsRemover

    plain = str.maketrans(ACCENTED, PLAIN)
    return sorted({form for w in StopWordsRemover.loadDefaultStopWords(language) for form in (w, w.translate(plain))})


def clean_tokens(column: Column | str, stop_words: list[str] | None = None, unicode: bool = False) -> Column:
    return without_stop_words(tokens(column, unicode), stop_words if stop_words is not None else ENGLISH_WORDS)


def fold(column: Column | str) -> Column:
    return F.translate(column, ACCENTED, PLAIN)


@F.arrow_udf(T.StringType())
def decomposed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Unicode's canonical decomposition, which Spark's functions lack; few texts at a time are held as Python's."""
    normal = lambda x: x if x is None else unicodedata.normalize("NFD", x)
    for texts in batches:
        parts = [pa.array(map(normal, texts.slice(i, 64).to_pylist()), pa.string()) for i in range(0, len(texts), 64)]
        yield pa.concat_arrays(parts) if parts else texts.cast(pa.string())


def fold_marks(column: Column | str) -> Column:
    """Letters without any combining mark, of all scripts; NULL becomes an empty text. ``fold`` is the way for the
    letters of its table and stays in the JVM, as do texts of ASCII here."""
    c = F.col(column) if isinstance(column, str) else column
    beyond = c.rlike(r"[^\x00-\x7F]")
    return F.when(beyond, F.regexp_replace(decomposed(F.when(beyond, c)), r"\p{Mn}", "")).otherwise(F.coalesce(c, F.lit("")))


def ngrams(array: Column, n: int = 2) -> Column:
    """Adjacent runs joined by a space; an empty array where there are too few tokens. Shifted copies of the array are
    zipped, so that it is not worked out anew for each element."""
    count = F.greatest(F.size(array) - (n - 1), F.lit(0))
    out = F.slice(array, F.lit(1), count)
    for i in range(1, n):
        out = F.zip_with(out, F.slice(array, F.lit(i + 1), count), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(array.isNotNull(), out)


def pooled(arrays: list[Column], distinct: bool = True) -> Column:
    """All tokens of several fields; NULL fields are empty."""
    whole = F.concat(*[F.coalesce(a, F.array().cast("array<string>")) for a in arrays])
    return F.array_distinct(whole) if distinct else whole


def less(w: str, n: int) -> str:
    return w[: max(len(w) - n, 0)]


def by_word(stem: Callable[[str], str], arrays: pa.Array) -> pa.Array:
    """Lists of words as lists of their stems; each distinct word of the batch is worked out once."""
    coded = arrays.flatten().cast(pa.string()).dictionary_encode()
    stems = pa.array([stem(w) for w in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)
    sizes = pc.fill_null(pc.list_value_length(arrays), 0).to_numpy(zero_copy_only=False)
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
    return pa.ListArray.from_arrays(offsets, stems, mask=arrays.is_null())


#: ending -> replacement, else the last letter goes (fixed values of the stemmer, as all endings below).
PALATAL = [(2, ["ci", "ce", "či", "če"], "k"), (2, ["zi", "ze", "ži", "že"], "h"), (3, ["čtě", "čti", "čtí"], "ck"), (3, ["ště", "šti", "ští"], "sk")]
#: (longer than, letters compared, endings, letters dropped, then palatalised)
CASES = [
    (7, 5, ["atech"], 5, False), (6, 4, ["ětem"], 3, True), (6, 4, ["atům"], 4, False),
    (5, 3, ["ech", "ich", "ích", "ého", "ěmi", "emi", "ému", "ete", "eti", "iho", "ího", "ími", "imu"], 2, True),
    (5, 3, ["ách", "ata", "aty", "ých", "ama", "ami", "ové", "ovi", "ými"], 3, False),
    (4, 2, ["em"], 1, True), (4, 2, ["es", "ém", "ím"], 2, True), (4, 2, ["ům", "at", "ám", "os", "us", "ým", "mi", "ou"], 2, False),
    (3, 1, list("eiíě"), 0, True), (3, 1, list("uyůaoáéý"), 1, False),
]
POSSESSIVES = [(5, 2, ["ov", "ův"], 2, False), (5, 2, ["in"], 1, True)]

#: The further, aggressive steps.
COMPARATIVES = [(5, 3, ["ejš", "ějš"], 2, True)]
DIMINUTIVES = [
    (7, 5, ["oušek"], 5, False), (6, 4, ["eček", "éček", "iček", "íček", "enek", "ének", "inek", "ínek"], 3, True), (6, 4, ["áček", "aček", "oček", "uček", "anek", "onek", "unek", "ánek"], 4, True),
    (5, 3, ["ečk", "éčk", "ičk", "íčk", "enk", "énk", "ink", "ínk"], 3, True), (5, 3, ["áčk", "ačk", "očk", "učk", "ank", "onk", "unk", "átk", "ánk", "ušk"], 3, False),
    (4, 2, ["ek", "ék", "ík", "ik"], 1, True), (4, 2, ["ák", "ak", "ok", "uk"], 1, False), (3, 1, ["k"], 1, False),
]
AUGMENTATIVES = [(6, 4, ["ajzn"], 4, False), (5, 3, ["izn", "isk"], 2, True), (4, 2, ["ák"], 2, False)]
DERIVATIONS = [
    (8, 6, ["obinec"], 6, False), (7, 5, ["ionář"], 4, True), (7, 5, ["ovisk", "ovstv", "ovišt", "ovník"], 5, False),
    (6, 4, ["ásek", "loun", "nost", "teln", "ovec", "ovík", "ovtv", "ovin", "štin"], 4, False), (6, 4, ["enic", "inec", "itel"], 3, True),
    (5, 3, ["árn"], 3, False), (5, 3, ["ěnk", "ián", "ist", "isk", "išt", "itb", "írn"], 2, True),
    (5, 3, ["och", "ost", "ovn", "oun", "out", "ouš", "ušk", "kyn", "čan", "kář", "néř", "ník", "ctv", "stv"], 3, False),
    (4, 2, ["áč", "ač", "án", "an", "ář", "as"], 2, False), (4, 2, ["ec", "en", "ěn", "éř", "íř", "ic", "in", "ín", "it", "iv"], 1, True),
    (4, 2, ["ob", "ot", "ov", "oň", "ul", "yn", "čk", "čn", "dl", "nk", "tv", "tk", "vk"], 2, False), (3, 1, list("cčklnt"), 1, False),
]
LIGHT_STEPS = [CASES, POSSESSIVES]
ALL_STEPS = [*LIGHT_STEPS, COMPARATIVES, DIMINUTIVES, AUGMENTATIVES, DERIVATIONS]


#: What Unicode has for word characters: general categories, and lettered symbols and joiners beside them (fixed values).
CATEGORIES = set("Lu Ll Lt Lm Lo Nl Mn Mc Me Nd Pc".split())
SYMBOLS = {chr(c) for r in (range(0x24B6, 0x24EA), range(0x1F130, 0x1F14A), range(0x1F150, 0x1F16A), range(0x1F170, 0x1F18A), range(0x200C, 0x200E)) for c in r}


def palatalised(w: str) -> str:
    return next((less(w, n) + by for n, suffixes, by in PALATAL if w[-n:] in suffixes), less(w, 1))


def by_endings(w: str, rules: list[tuple]) -> str:
    for longer, n, suffixes, drop, soften in rules:
        if len(w) > longer and w[-n:] in suffixes:
            return palatalised(less(w, drop)) if soften else less(w, drop)
    return w


@functools.lru_cache(100_000)
def czech_stem(token: str) -> str:
    lower, upper = token.lower(), token.upper()
    if lower == upper or not all(unicodedata.category(c) in CATEGORIES or c in SYMBOLS for c in token):
        return token
    s = functools.reduce(by_endings, ALL_STEPS, lower)
    if token == lower:
        return s
    if token == upper:
        return s.upper()
    return s[:1].upper() + s[1:].lower() if token == token[0].upper() + token[1:].lower() else token


@F.arrow_udf(T.ArrayType(T.StringType()))
def czech_aggressive(arrays: pa.Array) -> pa.Array:
    return by_word(czech_stem, arrays)


def cropped(w: Column, n: int) -> Column:
    return F.left(w, F.length(w) - n)


def ends(w: Column, n: int, suffixes: list[str]) -> Column:
    return F.right(w, F.lit(n)).isin(suffixes)


def palatal_column(w: Column) -> Column:
    out = None
    for n, suffixes, by in PALATAL:
        v = F.concat(cropped(w, n), F.lit(by))
        out = F.when(ends(w, n, suffixes), v) if out is None else out.when(ends(w, n, suffixes), v)
    return out.otherwise(cropped(w, 1))


def ending_column(w: Column, rules: list[tuple]) -> Column:
    out = None
    for longer, n, suffixes, drop, soften in rules:
        v = palatal_column(cropped(w, drop)) if soften else cropped(w, drop)
        hit = (F.length(w) > longer) & ends(w, n, suffixes)
        out = F.when(hit, v) if out is None else out.when(hit, v)
    return out.otherwise(w)


def czech_light(array: Column) -> Column:
    """The light stems, of two steps, as a column expression: they stay in the JVM."""

    def stem(token: Column) -> Column:
        # nested transforms bind the steps, so that each is worked out once
        stems = functools.reduce(lambda a, rules: F.transform(a, lambda w: ending_column(w, rules)), LIGHT_STEPS, F.array(F.lower(token)))
        s = F.get(stems, F.lit(0))
        first = F.upper(F.left(token, F.lit(1)))
        lettered = F.lower(token) != F.upper(token)
        capital = token == F.concat(first, F.lower(F.substring(token, 2, 1_000_000)))
        return (
            F.when(~token.rlike(r"^(?U)\w+$") | ~lettered, token)
            .when(token == F.lower(token), s)
            .when(token == F.upper(token), F.upper(s))
            .when(capital, F.concat(F.upper(F.left(s, F.lit(1))), F.lower(F.substring(s, 2, 1_000_000))))
            .otherwise(token)
        )

    return F.transform(array, stem)


def stem_czech(array: Column, aggressive: bool = False) -> Column:
    """Light Czech stems of tokens: case endings, then possessives (``aggressive``: and four more steps). Tokens of mixed case or with other than word
    characters stay as they are; an upper-cased or capitalised token keeps its form."""
    return czech_aggressive(array) if aggressive else czech_light(array)


def flatten_spaces(column: Column | str) -> Column:
    """The distinct words of a text, split at single spaces."""
    return F.array_distinct(F.split(column, " "))


#: The German stemmer of Snowball: vowels, letters before a final s and st, and endings of the three steps (fixed values).
GERMAN_VOWELS = "aeiouyäöü"
S_ENDING, ST_ENDING = "bdfghklmnrt", "bdfghklmnt"
DERIVED = [(4, ["lich", "heit"]), (4, ["keit"]), (4, ["isch"]), (3, ["end", "ung"]), (2, ["ig", "ik"])]


REGION = re.compile(f"([^{GERMAN_VOWELS}]*[{GERMAN_VOWELS}]+[^{GERMAN_VOWELS}])([^{GERMAN_VOWELS}]*[{GERMAN_VOWELS}]+[^{GERMAN_VOWELS}])?")
BETWEEN = {letter: re.compile(f"([{GERMAN_VOWELS}]){letter}([{GERMAN_VOWELS}])") for letter in "uy"}


def german_regions(w: str) -> tuple[int, int]:
    """Where R1 and R2 begin: after the first consonant that follows a vowel, and after the next such; R1 leaves three
    letters at least."""
    m, size = REGION.match(w), len(w)
    return (max(m.end(1), min(size, 3)) if m else size), (m.end(2) if m and m[2] else size)


@functools.lru_cache(100_000)
def german_stem(token: str) -> str:
    """Plural and case endings, then verb and adjective endings, then derivations, each only within its region. ss stands for
    ß; u and y between vowels are consonants, written in capitals until the end."""
    w = token.replace("ß", "ss")
    for letter in "uy":
        w = BETWEEN[letter].sub(rf"\1{letter.upper()}\2", w)
    r1, r2 = german_regions(w)
    cut = lambda n: less(w, n) if len(w) - n >= r1 else w
    niss = lambda n: less(w, n + less(w, n).endswith("niss")) if len(w) - n >= r1 else w
    if w.endswith("ern"):
        w = cut(3)
    elif w.endswith(("em", "er")):
        w = cut(2)
    elif w.endswith(("en", "es")):
        w = niss(2)
    elif w.endswith("e"):
        w = niss(1)
    elif w.endswith("s") and less(w, 1).endswith(tuple(S_ENDING)):
        w = cut(1)
    if w.endswith("est"):
        w = cut(3)
    elif w.endswith(("en", "er")) or w.endswith("st") and len(w) >= 6 and less(w, 2).endswith(tuple(ST_ENDING)):
        w = cut(2)
    n, suffixes = next(((n, suffixes) for n, suffixes in DERIVED if w.endswith(tuple(suffixes))), (0, [""]))
    if n and len(w) - n >= r2:
        whole, w, kind = w, less(w, n), suffixes[0]
        inside = lambda m, r: len(w) - m >= r  # of what is left
        if kind == "lich":
            w = less(w, 2) if w.endswith(("er", "en")) and inside(2, r1) else w
        elif kind == "keit":
            w = less(w, 4) if w.endswith("lich") and inside(4, r2) else less(w, 2) if w.endswith("ig") and inside(2, r2) else w
        elif kind == "end":
            w = less(w, 2) if w.endswith("ig") and not less(w, 2).endswith("e") and inside(2, r2) else w
        elif w.endswith("e"):  # isch, ig and ik stay after an e
            w = whole
    return w.translate(str.maketrans("UYäöü", "uyaou"))


@F.arrow_udf(T.ArrayType(T.StringType()))
def stems_of_german(arrays: pa.Array) -> pa.Array:
    return by_word(german_stem, arrays)


def stem_german(array: Column) -> Column:
    """Snowball's German stems of lower-cased tokens."""
    return stems_of_german(array)
