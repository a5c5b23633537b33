"""Keyword interests of users: dictionary, rarity and affinity, in long form (user, interest, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.functions import scalars, text


def keyword_tokens(definitions: DataFrame, keys: list[str], fields: list[str], bigrams: bool, variant: str) -> DataFrame:
    """(keys, token), distinct: the folded, cleaned (or stemmed) tokens of the keywords in all ``fields``; with ``bigrams``
    a keyword of several words gives its bigrams, whatever stands between them, and one of a single word that word."""
    rows = definitions.select(*keys, F.explode(text.pooled([F.col(f) for f in fields], distinct=False)).alias("keyword"))
    words = text.clean_tokens(text.fold("keyword"))
    words = text.stem_czech(words) if variant.startswith("stemmed") else words
    words = F.when(F.size(words) > 1, text.ngrams(words)).otherwise(words) if bigrams else words
    return rows.select(*keys, F.explode(words).alias("token")).distinct()


def interest_tokens(definitions: DataFrame, general: bool = False, bigrams: bool = False, variant: str = "cleaned") -> DataFrame:
    """(interest, token): the tokens of each interest's keywords, pooled."""
    level = "general_interest" if general else "subinterest"
    rows = definitions.withColumn("interest", F.col(level))
    return keyword_tokens(rows, ["interest"], ["keywords", *(["keywords_bigrams"] if bigrams else [])], bigrams, variant)


def paired_dictionary(definitions: DataFrame, variant: str = "cleaned") -> DataFrame:
    """(subinterest, general_interest, token): single keywords and bigrams of the interests that have both. A NULL level
    has no pair."""
    pair = ["subinterest", "general_interest"]
    one, two = (keyword_tokens(definitions, pair, [f], f.endswith("bigrams"), variant) for f in ("keywords", "keywords_bigrams"))
    return one.join(two.select(pair).distinct(), pair, "left_semi").unionByName(two.join(one.select(pair).distinct(), pair, "left_semi")).distinct()


def tokens_of_interest(views: DataFrame, vocabulary: DataFrame, tokens: str = "tokens") -> DataFrame:
    """(user_id, ts, token) of the tokens that some interest names."""
    return views.select("user_id", "ts", F.explode(tokens).alias("token")).join(vocabulary.select("token").distinct(), "token", "left_semi")


def rarity(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(interest, idf, share): ln of rows over matching rows, and its place between the least and the greatest."""
    n = tokens.agg(F.count("*").alias("n"))
    sums = tokens.groupBy("token").agg(F.count("*").alias("c")).join(vocabulary, "token").groupBy("interest").agg(F.sum("c").alias("s"))
    all_ = vocabulary.select("interest").distinct().join(sums, "interest", "left").crossJoin(F.broadcast(n))
    idf = all_.select("interest", F.ln(F.try_divide(F.col("n").cast("double"), F.col("s").cast("double"))).alias("idf"))
    ends = idf.agg(F.min("idf").alias("lo"), F.max("idf").alias("hi"))
    return idf.crossJoin(F.broadcast(ends)).select("interest", "idf", F.try_divide(F.col("idf") - F.col("lo"), F.col("hi") - F.col("lo")).alias("share"))


def affinities(tokens: DataFrame, vocabulary: DataFrame, windows: int = 7, variant: str = "logit") -> DataFrame:
    """(user_id, interest, affinity) of the interests that the user's tokens match; work follows the matches, not
    tokens times interests."""
    sums = tokens.groupBy("user_id", "token").agg(F.count("*").alias("c")).join(vocabulary, "token").groupBy("user_id", "interest").agg(F.sum("c").cast("double").alias("s"))
    if variant == "tanh":
        return sums.select("user_id", "interest", scalars.legacy_affinity(F.col("s")).alias("affinity"))
    met = sums.join(rarity(tokens, vocabulary), "interest")
    return met.select("user_id", "interest", scalars.affinity(F.col("s"), windows, F.col("share")).alias("affinity"))


def wide(long: DataFrame, interests: list[str], prefix: str = "affinity_") -> DataFrame:
    """One column an interest, for stores that want them; 0 where there is no match."""
    rows = long.groupBy("user_id").pivot("interest", interests).agg(F.first("affinity")).fillna(0.0)
    return rows.select("user_id", *[F.col(i).alias(f"{prefix}{i}") for i in interests])
