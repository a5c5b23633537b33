"""User agents and search engines: ordered rules of contained words, as column expressions.

The word lists are fixed values. Agents are lower-cased first, so rules with capitals never match; they are kept for
the record and cost nothing. A NULL agent has NULL for every attribute.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: (any of these words, value); the first rule that holds decides.
BRANDS = [
    (["iphone", "macintosh", "ipad"], "apple"), (["nokia"], "nokia"), (["huawei", "MARX-L"], "huawei"), (["samsung", "sm-t"], "samsung"), (["redmi", "mi"], "xiaomi"),
    (["aligator"], "aligator"), (["moto"], "motorola"), (["lenovo"], "lenovo"), (["lm-g900"], "lg"), (["pixel"], "google"),
]
#: A value that starts with ~ is a pattern to extract.
MARKETING = [
    (["iphone"], "iphone"), (["macintosh"], "mac"), (["ipad"], "ipad"), (["lenovo tab", "lenovo tb"], "lnv_tab"), (["sm-t"], "galaxy_tab"), (["sm-g"], "galaxy"), (["lm-g900"], "velvet"),
    (["smart-tv"], "smart_tv"), (["MARX-L"], "P30_lite"), (["pixel"], r"~(pixel)(\s)(\d+)"), (["redmi"], r"~(redmi)(\s\w+)*"), ([" mi "], r"~(mi)(\s\w+)*"),
]
SYSTEMS = [(["iphone"], "ios"), (["ipad"], "ipados"), (["android"], "android"), (["windows"], "windows"), (["macintosh"], "macos"), (["ubuntu", "CrOS", "x86_64"], "linux")]
VERSIONS = [("android", r"android (\d+)", 1), ("iphone", r"(\d+)(_)(\d)", 0), ("windows", r"nt (\d+)", 1)]
DESKTOP, TABLETS = ["windows", "macos", "linux"], ["ipad", "lnv_tab", "galaxy_tab"]
NOT_SAFARI = ["chrome", "firefox", "edg", "sznprohlizec", "opr", "crios"]
BROWSERS = [("edg", "edge"), ("opr", "opera"), ("sznprohlizec", "seznam")]
ENGINES = ["google", "seznam", "bing", "centrum", "yahoo", "volny", "ask"]
GROUPED_ENGINES = ["seznam", "google", "centrum", "bing", "yahoo"]


def any_word(c: Column, words: list[str]) -> Column:
    found = c.contains(words[0])
    for w in words[1:]:
        found = found | c.contains(w)
    return found


def by_rules(c: Column, rules: list[tuple[list[str], str]]) -> Column:
    out = None
    for words, value in rules:
        v = F.regexp_extract(c, value[1:], 0) if value[0] == "~" else F.lit(value)
        out = F.when(any_word(c, words), v) if out is None else out.when(any_word(c, words), v)
    return out


def parse(agent: str = "user_agent") -> list[Column]:
    """brand, marketing name, system, version, category and browser, for one ``select``."""
    ua = F.lower(F.col(agent))
    brand, marketing, system = by_rules(ua, BRANDS), by_rules(ua, MARKETING), by_rules(ua, SYSTEMS)
    version = None
    for word, pattern, group in VERSIONS:
        got = F.regexp_extract(ua, pattern, group)
        version = F.when(ua.contains(word), got) if version is None else version.when(ua.contains(word), got)
    tablet = marketing.isin(TABLETS)
    category = (
        F.when(system.isin(DESKTOP), "desktop")
        .when((system == "ios") | ((system == "android") & (~tablet | marketing.isNull() | brand.isNull())), "mobile")
        .when(tablet, "tablet")
        .when(marketing == "smart_tv", "TV")
    )
    browser = F.when(ua.contains("firefox"), "mozilla").when(ua.contains("mac") & ~any_word(ua, NOT_SAFARI), "safari")
    for word, name in BROWSERS:
        browser = browser.when(ua.contains(word), name)
    browser = browser.when(ua.isNull() | (ua == ""), F.lit(None)).otherwise("chrome")
    return [
        brand.alias("device_brand_name"), F.regexp_replace(marketing, "build", "").alias("device_marketing_name"), system.alias("os_name"),
        version.alias("os_version"), category.alias("device_category"), browser.alias("browser_name"),
    ]


def search_engine(host: str, url: str) -> Column:
    """The first engine named in the referring host, else in the page's URL."""

    def named(column: str) -> Column:
        c = F.lower(F.col(column))
        out = F.when(c == "", F.lit(None))
        for e in ENGINES:
            out = out.when(c.contains(e), e)
        return out

    return F.coalesce(named(host), named(url))


def grouped_engine(column: str) -> Column:
    """Five named engines; '' stays, all others become NULL."""
    c = F.col(column)
    out = F.when(c == "", "")
    for e in GROUPED_ENGINES:
        out = out.when(c.contains(e), e)
    return out
