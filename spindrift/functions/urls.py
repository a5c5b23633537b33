"""URL canonicalisation as column expressions.

Each form is a list of steps (fixed values of the domain: the patterns decide which answers users get); ``apply`` folds
the steps into one expression, so that a form is one projection whatever its length. Forms keep the known quirks of
their patterns (an unescaped dot, a lost top-level domain): users' tables are keyed by these answers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = tuple
FORBIDDEN = r"[~!@#$%^&*()=+\\|?<>:'\"\[\]{} ,].*$"
LOWER: Step = ("lower",)


def sub(pattern: str, by: str = "") -> Step:
    return ("sub", pattern, by)


SCHEME, LEADING_DOT = sub(r"^((https?|ftp)://)?"), sub(r"^\.")
MOBILE = [sub(r"^m\."), sub(r"\.m\.", ".")]
PREFIX = [LOWER, SCHEME, LEADING_DOT, sub(FORBIDDEN), *MOBILE]
TRIM = [sub(r"[.\-/]$"), sub(r"www."), sub(r"m,.")]
NORMALISED = [*PREFIX, sub(r".php$"), sub(r".html$"), sub(r"\.[0-9a-zA-z_-]*$"), sub(r"^(www.)?"), sub(r"/$")]
AD = [*PREFIX, ("extract", r"^[^/]+(/[^/.]+)?"), ("crop", 99), *TRIM]
AD_LIGHT = [*PREFIX, *TRIM]
TWO_LEVEL = [*PREFIX, ("extract", r"^[^/]+(/[^/.]+)(/[^/.]+)"), ("crop", 99), *TRIM]
RTB = [LOWER, sub(r"^((https?|ftp)://)?(ww+[^.]*\.)?"), LEADING_DOT, sub(FORBIDDEN), ("extract", r"^[^/]+(/[^/.]+)?"), ("crop", 99), sub(r"[.\-/]$"), *MOBILE]
CLEAN = [LOWER, SCHEME, LEADING_DOT, sub(r"/$"), sub(r"[?#].*$")]
CROPPED = [("extract", r"^((https?://|ftp://))?[^/]*/?[^/]*/?"), sub(r"^((https?|ftp)://)?(ww+[^.]*\.)?(\*\.)?(m\.)?(mobil\.)?(3c\.)?"), sub(r"/#?$"), sub(FORBIDDEN)]


def apply(column: Column | str, steps: list[Step]) -> Column:
    """The steps over a column; NULL stays NULL, '' stays ''."""

    def one(c: Column, step: Step) -> Column:
        kind = step[0]
        if kind == "lower":
            return F.lower(c)
        if kind == "sub":
            return F.regexp_replace(c, step[1], step[2])
        if kind == "extract":
            return F.regexp_extract(c, step[1], 0)
        return F.substring(c, 1, step[1])

    return reduce(one, steps, F.col(column) if isinstance(column, str) else column)


def normalise(column: Column | str) -> Column:
    return apply(column, NORMALISED)


def ad_format(column: Column | str, light: bool = False) -> Column:
    return apply(column, AD_LIGHT if light else AD)


def two_level(column: Column | str) -> Column:
    return apply(column, TWO_LEVEL)


def rtb_domain(column: Column | str) -> Column:
    return apply(column, RTB)


def clean(column: Column | str) -> Column:
    return apply(column, CLEAN)


def cropped(column: Column | str) -> Column:
    return apply(column, CROPPED)


def domain(column: Column | str, subdomains: int | None = None) -> Column:
    """The host; with ``subdomains`` its last label (0), last two (1) or last three (2)."""
    host = F.split_part(apply(column, AD_LIGHT), F.lit("/"), F.lit(1))
    if subdomains is None:
        return host
    labels = F.split(host, r"\.")
    last = F.least(F.size(labels), F.lit(subdomains + 1))
    return F.array_join(F.slice(labels, F.size(labels) - last + 1, last), ".")


def decode(column: Column | str) -> Column:
    """Percent-decoding; NULL where the text is malformed."""
    return F.try_url_decode(column)


def is_general(column: Column | str, pages: list[str]) -> Column:
    """Whether a URL holds one of the pages (patterns) that are too general to tell an audience."""
    c = F.col(column) if isinstance(column, str) else column
    return c.rlike("|".join(pages)) if pages else F.lit(False)


def all_forms(column: str) -> list[Column]:
    """Every stored form of the URL dictionary, for one ``select``."""
    return [
        normalise(column).alias("url_normalized"), domain(column, 0).alias("url_domain_full"), domain(column, 1).alias("url_domain_1_level"),
        domain(column, 2).alias("url_domain_2_level"), ad_format(column).alias("url_ad_format"), two_level(column).alias("url_two_level"),
    ]
