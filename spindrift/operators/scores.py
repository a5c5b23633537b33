"""Survey-weighted income and education scores and the final A to E bracket.

Coefficients are small tables (domain, interest or flag; one ``score_<bracket>`` column each). Spark broadcasts them if
their size allows. Everything stays lazy; only Box-Cox's grid values reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindrift.functions import scalars
from spindrift.operators import rank, stats
from spindrift.sources.session import fixed

INCOME, EDUCATION = ["low", "mid", "high"], ["zs", "ss_no", "ss_yes", "vs"]
WEIGHTS = {"interest": 3 / 12, "url": 5 / 12, "other": 4 / 12}
INCOME_WEIGHT, EDUCATION_WEIGHT = 1.0, 0.7


def named(brackets: list[str], prefix: str = "score_") -> list[str]:
    return [f"{prefix}{b}" for b in brackets]


def url_scores(views: DataFrame, coefficients: DataFrame, brackets: list[str], domain: str = "domain", monitor: bool = False) -> DataFrame:
    """user_id, n_urls, score_<bracket>: mean coefficient of the user's views (0 where a domain has none) times the
    coefficient of their count. ``monitor`` adds the user's distinct domains, sorted, and latest view (``ts``)."""
    cols = named(brackets)
    rows = views.join(coefficients, domain, "left").fillna(0.0, cols)
    seen = [F.array_sort(F.collect_set(domain)).alias("domains"), F.max("ts").alias("latest")] if monitor else []
    means = rows.groupBy("user_id").agg(F.count("*").alias("n_urls"), *[F.avg(c).alias(c) for c in cols], *seen)
    scored = [(scalars.count_coefficient(F.col("n_urls")) * F.col(c)).alias(c) for c in cols]
    return means.select("user_id", "n_urls", *scored, *(["domains", "latest"] if monitor else []))


def interest_scores(affinities: DataFrame, coefficients: DataFrame, brackets: list[str]) -> DataFrame:
    """user_id, score_<bracket>: affinities times coefficients, summed (an interest without coefficients adds none)."""
    cols = named(brackets)
    rows = affinities.join(coefficients, "interest", "left")
    return rows.groupBy("user_id").agg(*[F.sum(F.col("affinity") * F.col(c)).alias(c) for c in cols])


def web_flags(features: DataFrame, fill: bool = False) -> DataFrame:
    """Flags of a user's habits; NULL habits give NULL flags unless ``fill`` (0)."""
    flags = {
        "seznam_flag": F.col("engine_most_common") == "seznam", "safari_flag": F.col("browser_most_common") == "safari", "desktop_flag": F.col("device_type_most_common") == "desktop",
        "tv_flag": F.col("device_type_most_common") == "TV", "more_devices_flag": F.col("n_device_categories") >= 2,
    }
    out = features.select("user_id", *[v.cast("int").alias(k) for k, v in flags.items()])
    return out.fillna(0) if fill else out


def location_flags(traits: DataFrame, names: DataFrame) -> DataFrame:
    """countryside_flag and regional_town_flag of users from their segments' place names."""
    rows = traits.join(names, "segment_id", "left")
    like = {"prague": "%Praha%", "region": "%kraj%", "city": "%City%"}
    users = rows.groupBy("user_id").agg(F.count_distinct("name").alias("n_places"), *[F.coalesce(F.bool_or(F.col("name").like(p)), F.lit(False)).alias(k) for k, p in like.items()])
    place = scalars.location_class(F.col("n_places"), F.col("city"), F.col("prague"))
    return users.select("user_id", "n_places", place.alias("location"), *[(place == k).cast("int").alias(f"{k}_flag") for k in ("countryside", "regional_town")])


def other_scores(flags: DataFrame, coefficients: DataFrame, brackets: list[str]) -> DataFrame:
    """user_id, score_<bracket>: coefficients of the user's flags, summed."""
    cols = named(brackets)
    long = stats.melt(flags.fillna(0), ["user_id"], [c for c in flags.columns if c.endswith("_flag")], "flag", "value")
    return long.join(coefficients, "flag").groupBy("user_id").agg(*[F.sum(F.col("value") * F.col(c)).alias(c) for c in cols])


def transformed(scores: DataFrame, brackets: list[str], sharpness: float = 1.0, normalise: bool = True, digits: int = 4) -> DataFrame:
    """Box-Cox (lambdas of ``digits`` places), standardisation and a sigmoid to (-1, 1). The scores are read several
    times, so they are fixed first."""
    cols = named(brackets)
    scores = fixed(scores)
    out = stats.box_cox_transform(scores, cols, digits=digits) if normalise else scores
    return stats.standardise(out, cols).withColumns({c: scalars.sigmoid(F.col(c), sharpness) for c in cols})


def blended(parts: dict[str, DataFrame], brackets: list[str], weights: dict[str, float] = WEIGHTS, ranked: bool = True, digits: int = 9) -> DataFrame:
    """user_id, score_<bracket> in (0, 1) and, if ``ranked``, score_<bracket>_rank: users with all parts, weighted. Scores
    that are ranked have ``digits`` places, so that sums of the same parts in another order tie."""
    cols = named(brackets)
    out = None
    for name, df in parts.items():
        part = df.select("user_id", *[F.col(c).alias(f"{name}_{c}") for c in cols])
        out = part if out is None else out.join(part, "user_id", "left")
    out = out.dropna("any")
    score = {c: scalars.positive_sigmoid(scalars.total([weights[n] * F.col(f"{n}_{c}") for n in parts])) for c in cols}
    out = out.select("user_id", *[v.alias(c) for c, v in score.items()])
    return rank.percent_ranks(fixed(out.withColumns({c: F.round(c, digits) for c in cols})), cols, key="user_id") if ranked else out


def combinations(income: str = "income_", education: str = "education_") -> dict[str, Column]:
    """All income and education pairs, as columns of a frame with both sets of scores."""
    return {f"{i}_{e}": INCOME_WEIGHT * F.col(f"{income}{i}") + EDUCATION_WEIGHT * F.col(f"{education}{e}") for i in INCOME for e in EDUCATION}


def abcde(df: DataFrame) -> DataFrame:
    """user_id, A to E and their percent ranks, from income_<b> and education_<b> columns."""
    pairs = combinations()
    rows = df.select("user_id", *[v.alias(k) for k, v in pairs.items()])
    letters = scalars.brackets({k: F.col(k) for k in pairs})
    return rank.percent_ranks(fixed(rows.select("user_id", *[v.alias(k) for k, v in letters.items()])), list(letters), key="user_id")


def missing_parts(stored: DataFrame, family: str, timestamp: Column, parts: dict) -> dict[str, DataFrame]:
    """Of the named parts (functions without arguments that give a frame) those that the table of partial scores
    (family, part, timestamp, ...) has not yet for a run; only these are built."""
    done = {r[0] for r in stored.where((F.col("family") == family) & (F.col("timestamp") == timestamp)).select("part").distinct().collect()}
    return {name: build() for name, build in parts.items() if name not in done}
