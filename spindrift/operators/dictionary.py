"""Tokens of a dictionary of URLs: of each described field and pooled over all fields, plain, stemmed and in pairs."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.functions import text

KINDS = ["cleaned", "stemmed"]
#: Choice of tokens -> kind.
VARIANTS = {f"{k}_unique": k for k in KINDS}


def field_tokens(df: DataFrame, fields: list[str], stop_words: list[str] | None = None) -> DataFrame:
    """``df`` with arrays <field>_cleaned and <field>_stemmed; a NULL field has empty ones."""
    cleaned = {f"{f}_cleaned": F.coalesce(text.clean_tokens(f, stop_words), F.array().cast("array<string>")) for f in fields}
    return df.withColumns(cleaned).withColumns({f"{f}_stemmed": text.stem_czech(F.col(f"{f}_cleaned")) for f in fields})


def pooled_tokens(df: DataFrame, fields: list[str], pairs: bool = True) -> DataFrame:
    """``df`` with tokens_all_<kind> (fields in the order given) and tokens_all_<kind>_unique; with ``pairs`` also both of
    the bigrams (..._bigrams), which never cross from one field to the next."""
    out = df
    for kind in KINDS:
        arrays = {"": [F.col(f"{f}_{kind}") for f in fields]}
        if pairs:
            arrays["_bigrams"] = [text.ngrams(a) for a in arrays[""]]
        out = out.withColumns({f"tokens_all_{kind}{x}": text.pooled(a, distinct=False) for x, a in arrays.items()})
        out = out.withColumns({f"tokens_all_{kind}_unique{x}": F.array_distinct(f"tokens_all_{kind}{x}") for x in arrays})
    return out


def chosen(dictionary: DataFrame, variant: str = "cleaned_unique", bigrams: bool = False, key: str = "url_normalized") -> DataFrame:
    """(key, tokens) by the name of a variant; one that is unknown warns and takes the cleaned tokens."""
    if variant not in VARIANTS:
        warnings.warn(f"no variant {variant} of tokens; cleaned ones are taken", stacklevel=2)
    column = f"tokens_all_{VARIANTS.get(variant, 'cleaned')}_unique"
    tokens = F.concat(column, f"{column}_bigrams") if bigrams else F.col(column)
    return dictionary.select(key, tokens.alias("tokens"))


def with_tokens(views: DataFrame, tokens: DataFrame, key: str = "url_normalized") -> DataFrame:
    """Page views with the tokens of their URL, NULL where the dictionary lacks it. Both sides are shuffled by URL unless
    Spark finds the dictionary small; a hot URL is split by adaptive execution."""
    return views.drop("tokens").join(tokens, key, "left")
