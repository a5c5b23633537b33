"""Declared socio-demographic targets, segments and look-alike targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindrift.functions import scalars


def declared(hits: DataFrame) -> DataFrame:
    """Cleaned age and gender codes of hits."""
    return hits.withColumns({"age": scalars.clean_age(F.col("age")), "gender": scalars.clean_gender(F.col("gender"))})


def trusted(df: DataFrame, publishers: list[str], publisher: str = "publisher") -> DataFrame:
    """Age and gender are 'unknown' unless a listed publisher declared them."""
    listed = F.col(publisher).isin(publishers)
    return df.withColumns({c: F.when(listed, F.col(c)).otherwise("unknown") for c in ("age", "gender")})


def resolved(df: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """target_age and target_gender of each user: the only known label, else 'unknown'. With ``users``, theirs (NULL
    for users who declared nothing). No more than two labels are kept in a user's aggregate."""
    rows = df.withColumns({"age": scalars.age_band(F.col("age")), "gender": scalars.gender_label(F.col("gender"))})

    def only(c: str):
        known = F.when(F.col(c) != "unknown", F.col(c))
        return F.when(F.min(known) == F.max(known), F.min(known)).otherwise("unknown").alias(f"target_{c}")

    out = rows.groupBy("user_id").agg(only("age"), only("gender"))
    return users.join(out, "user_id", "left") if users is not None else out


def segment_ids(models: DataFrame, column: str = "segment_ids") -> DataFrame:
    """Distinct ids of comma lists."""
    return models.select(F.explode(F.split(column, ",")).alias("s")).select(F.trim("s").alias("segment_id")).where("segment_id <> ''").distinct()


def ingest_members(responses: DataFrame) -> DataFrame:
    """(user_id, segment_id) from landed API responses: segment_id and events array<struct<userId>>."""
    return responses.select("segment_id", F.explode("events").alias("e")).select(F.col("e.userId").alias("user_id"), "segment_id").where("user_id is not null").distinct()


def synced_catalogue(catalogue: DataFrame, stored: DataFrame, key: str = "id") -> DataFrame:
    """The catalogue with the trained model of the stored table; write it to a new place and swap."""
    return catalogue.drop("model").join(stored.select(key, "model"), key, "left")


def lookalike_targets(users: DataFrame, members: DataFrame, models: DataFrame, names: list[str]) -> DataFrame:
    """One 0/1 column a model and the comma list of those set: a user is a target if in any of its segments. One pass
    over the members for all models."""
    of_model = models.select("model", F.explode(F.split("segment_ids", ",")).alias("segment_id")).select("model", F.trim("segment_id").alias("segment_id"))
    found = members.join(of_model, "segment_id").groupBy("user_id").pivot("model", names).agg(F.max(F.lit(1)))
    out = users.join(found, "user_id", "left").fillna(0, names)
    return out.withColumn("models", scalars.flag_list({n: F.col(n) for n in names}))


def list_matches(views: DataFrame, lists: DataFrame) -> DataFrame:
    """user_id, band, n_primary, n_secondary: views of curated domains (columns band, tier, domain of ``lists``, a small
    table that callers keep) by the audience band they speak for."""
    met = views.join(lists.select("band", "tier", "domain").distinct(), "domain")
    return met.groupBy("user_id", "band").agg(F.count_if(F.col("tier") == "primary").alias("n_primary"), F.count_if(F.col("tier") == "secondary").alias("n_secondary"))
