"""Scalar formulas of scores, bands and flags, as column expressions."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

BRACKETS = {
    "A": ["high_vs", "high_ss_yes"], "B": ["high_ss_yes", "mid_vs"], "C": ["mid_ss_yes", "mid_ss_no", "high_ss_no"], "D": ["low_ss_yes", "mid_zs"], "E": ["low_zs", "low_ss_no"],
}
AGE_BANDS = [(0, 17), (18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, 100)]
PERIODS = [(5, 8, "Early morning"), (9, 11, "Late morning"), (12, 15, "Early afternoon"), (16, 17, "Late afternoon"), (18, 20, "Early evening"), (21, 23, "Late evening")]


def positive_sigmoid(x: Column) -> Column:
    """(0, 1)."""
    return x / (2 * (1 + F.abs(x))) + 0.5


def sigmoid(x: Column, sharpness: float) -> Column:
    """(-1, 1)."""
    return sharpness * x / F.sqrt(1 + sharpness**2 * x * x)


def count_coefficient(n: Column) -> Column:
    """Rises with the fourth root of the count and stays from 30 on."""
    return F.pow(F.least(n, F.lit(30)) - 0.75, F.lit(0.25))


def affinity(s: Column, n: float, share: Column, digits: int = 5) -> Column:
    """Index of a sum of matches over ``n`` windows, with the interest's relative rarity (0 to 1; NULL: no match)."""
    z = -(0.25 + 0.5 * share * s / n) + 4 * F.exp(-s / n)
    return F.round(1 / (1 + F.exp(z)), digits) - 0.02298


def legacy_affinity(s: Column) -> Column:
    return F.round(F.greatest(F.tanh(F.ln(0.5 + s)), F.lit(0.0)), 5)


def visit_period(hour: Column) -> Column:
    out = None
    for a, b, name in PERIODS:
        out = F.when(hour.between(a, b), name) if out is None else out.when(hour.between(a, b), name)
    return out.otherwise("Night")


def location_class(places: Column, city: Column, prague: Column) -> Column:
    return F.when((places >= 1) & ~city & ~prague, "countryside").when((places == 2) & city & ~prague, "regional_town").otherwise("none")


def clean_age(c: Column) -> Column:
    """Whole years from 0 to 100, as text; all else 'unknown'."""
    years = c.try_cast("int")
    return F.when(years.between(0, 100), years.cast("string")).otherwise("unknown")


def clean_gender(c: Column) -> Column:
    """Codes 1 and 2 change places; all else is 'unknown'."""
    return F.when(c == "1", "2").when(c == "2", "1").otherwise("unknown")


def age_band(c: Column) -> Column:
    """Number of the band, as text; 'unknown' where the age is no number of a band."""
    years, out = c.try_cast("int"), None
    for i, (a, b) in enumerate(AGE_BANDS):
        out = F.when(years.between(a, b), str(i)) if out is None else out.when(years.between(a, b), str(i))
    return out.otherwise("unknown")


def gender_label(c: Column) -> Column:
    """Declared code to label; NULL for all others."""
    return F.when(c == "1", "0").when(c == "2", "1")


def parameter(column: str, group: str) -> Column:
    """Item of the first entry of a group in array<struct<group, item>>; NULL for empty and NULL arrays."""
    return F.get(F.filter(column, lambda x: x["group"] == group), F.lit(0))["item"]


def element(vector: str, i: int) -> Column:
    """Element of an ml vector."""
    return F.get(vector_to_array(vector), F.lit(i))


def share_in(array: Column, values: list[str]) -> Column:
    """Share of an array's elements in a fixed set; 0 for empty and NULL arrays."""
    return F.coalesce(F.try_divide(F.size(F.filter(array, lambda x: x.isin(values))).cast("double"), F.size(array).cast("double")), F.lit(0.0))


def day_number_to_date(c: Column) -> Column:
    """20240131 -> a date; NULL for what is no day."""
    return F.try_to_date(c.cast("string"), "yyyyMMdd")


def total(columns: list[Column]) -> Column:
    return reduce(operator.add, columns)


def flag_list(flags: dict[str, Column]) -> Column:
    """Names of the flags that are set, joined by commas; '' if none."""
    return F.concat_ws(",", *[F.when(v == 1, name) for name, v in flags.items()])


def brackets(scores: dict[str, Column]) -> dict[str, Column]:
    """A to E, each the greatest of its combinations (NULLs are skipped)."""
    return {b: F.greatest(*[scores[k] for k in keys]) for b, keys in BRACKETS.items()}


def split_at(column: Column | str, separator: str, i: int) -> Column:
    """i-th part; NULL beyond the last."""
    return F.get(F.split(column, separator), F.lit(i))


def parse_list(column: Column | str) -> Column:
    """'[a, "b"]' or 'a, b' to an array of trimmed texts; '' and '[]' to an empty one."""
    c = F.trim(F.translate(F.col(column) if isinstance(column, str) else column, "[]'\"", ""))
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(c, ","), lambda x: F.trim(x)))
