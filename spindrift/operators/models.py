"""Inputs of fitted models and scores from them, with all ranks in one pass."""

from __future__ import annotations

import json
import warnings

from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spindrift.functions import scalars
from spindrift.operators import rank
from spindrift.sources.session import fixed
from spindrift.sources.versions import missing_path


def fields_of(schema: T.StructType | str, label: str = "label") -> dict[str, list[str]]:
    """Field names by use: ``flags`` (end in _flag), ``categories`` (strings) and ``numbers``."""
    schema = T.StructType.fromJson(json.loads(schema)) if isinstance(schema, str) else schema
    fields = [f for f in schema.fields if f.name != label]
    flags = [f.name for f in fields if f.name.endswith("_flag")]
    categories = [f.name for f in fields if isinstance(f.dataType, T.StringType) and f.name not in flags]
    return {"flags": flags, "categories": categories, "numbers": [f.name for f in fields if f.name not in flags and f.name not in categories]}


def with_url_flags(df: DataFrame, domains: dict[str, str], urls: str = "urls") -> DataFrame:
    """A 0/1 column for each named domain (NULL lists give NULL)."""
    return df.withColumns({name: F.array_contains(urls, d).cast("int") for name, d in domains.items()})


def prepared(df: DataFrame, fields: dict[str, list[str]], known: dict[str, list[str]]) -> DataFrame:
    """Rare categories and NULLs become 'None', NULL numbers and flags 0."""
    names = [c for c in fields["categories"] if c in df.columns]
    out = df.withColumns({c: F.when(F.col(c).isin(known[c]), F.col(c)).otherwise("None") for c in names if c in known})
    return out.fillna(0, fields["numbers"] + fields["flags"]).fillna("None", names)


def with_urls(features: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Features with the users' collected URLs, and one row that counts the users without."""
    joined = features.join(urls, "user_id", "left")
    return joined, joined.agg(F.count_if(F.col("urls").isNull()).alias("unmatched"), F.count("*").alias("n"))


def probability(df: DataFrame, model: Transformer, name: str) -> DataFrame:
    """``df`` with the probability of the positive class as column ``name``. A two-class logistic model is an expression of
    its coefficients: its own transformer holds on to the training session, which can't always be sent to tasks."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    last, out, before = stages[-1], df, df.columns
    for stage in stages[:-1]:
        out = stage.transform(out)
    if not isinstance(last, LogisticRegressionModel) or last.numClasses != 2:
        return last.transform(out).select(*before, scalars.element("probability", 1).alias(name))
    weights = F.array(*[F.lit(float(w)) for w in last.coefficients.toArray()])
    products = F.zip_with(vector_to_array(last.getFeaturesCol()), weights, lambda x, w: x * w)
    margin = F.aggregate(products, F.lit(float(last.intercept)), lambda total, x: total + x)
    return out.select(*before, (1 / (1 + F.exp(-margin))).alias(name))


def load(paths: dict[str, str], optional: bool = False) -> dict[str, PipelineModel | None]:
    """Fitted models by name. With ``optional`` a model whose path does not exist is None, with a warning; any other fault,
    such as a lost cluster or a broken model, is an error."""
    found: dict[str, PipelineModel | None] = {}
    for name, path in paths.items():
        try:
            found[name] = PipelineModel.load(path)
        except AnalysisException as e:
            if not optional or not missing_path(e):
                raise
            warnings.warn(f"model {name}: {e}", stacklevel=2)
            found[name] = None
    return found


def score_all(df: DataFrame, models: dict[str, Transformer | None], key: str = "user_id", complement: dict[str, str] | None = None, missing: float | None = -1.0) -> DataFrame:
    """key (one row each), <model>_probability and <model>_percentile. A missing model gives ``missing`` (None: NULL) for both.
    ``complement``: name of an opposite class -> model, one minus both. Probabilities are ranked together."""
    out, trained = df, [m for m, t in models.items() if t is not None]
    for name in trained:
        out = probability(out, models[name], f"{name}_probability")
    cols = [f"{m}_probability" for m in trained]
    # models run once, not in each reading of the ranks
    out = rank.percent_ranks(fixed(out.select(key, *cols)), cols, key=key) if cols else out.select(key)
    out = out.withColumnsRenamed({f"{m}_probability_rank": f"{m}_percentile" for m in trained})
    absent = F.lit(missing).cast("double")
    out = out.withColumns({f"{m}_{x}": absent for m in models if m not in trained for x in ("probability", "percentile")}) if len(trained) < len(models) else out
    return out.withColumns({f"{other}_{x}": 1 - F.col(f"{m}_{x}") for other, m in complement.items() for x in ("probability", "percentile")}) if complement else out


def pipeline(fields: dict[str, list[str]], estimator, label: str = "label", drop_last: bool = False) -> Pipeline:
    """Indexers and one encoder for the categories (unseen ones get a place of their own), an assembler with the numbers and
    flags, and the estimator: one model to fit, save and load. Use of the fields as ``fields_of`` gives it."""
    categories, plain = fields["categories"], fields["numbers"] + fields["flags"]
    stages = []
    places = [rank.free_name(categories + plain, f"{c}_place") for c in categories]
    if categories:
        codes = [rank.free_name([*categories, *plain, *places], f"{c}_code") for c in categories]
        stages.append(StringIndexer(inputCols=categories, outputCols=codes, handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=codes, outputCols=places, dropLast=drop_last, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=[*plain, *places], outputCol="features"))
    return Pipeline(stages=[*stages, estimator.setLabelCol(label).setFeaturesCol("features")])


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def feature_columns(model: PipelineModel, df: DataFrame) -> list[tuple[str, str]]:
    """(name, column of ``df`` that it comes from) of each place of the assembled vector, from the vector's own metadata."""
    out = df
    for stage in model.stages[:-1]:
        out = stage.transform(out)
    attrs = out.schema[model.stages[-1].getFeaturesCol()].metadata["ml_attr"]["attrs"]
    names = {a["idx"]: a["name"] for group in attrs.values() for a in group}
    sources = {c: c for c in df.columns}
    if isinstance(model.stages[0], StringIndexerModel):
        sources |= dict(zip(model.stages[1].getOutputCols(), model.stages[0].getInputCols(), strict=True))

    def source(name: str) -> str:
        return next(sources[s] for s in sorted(sources, key=len, reverse=True) if name == s or name.startswith(f"{s}_"))

    return [(names[i], source(names[i])) for i in range(len(names))]


def column_importances(spark: SparkSession, model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, column, importance) of a pipeline's last stage, a tree model or a linear one: each encoded place by the
    column it was made from."""
    places = feature_columns(model, df)
    found = importances(spark, model.stages[-1], [n for n, _ in places])
    return found.join(spark.createDataFrame(places, "feature string, column string"), "feature").select("feature", "column", "importance")


def importances(spark: SparkSession, model, columns: list[str]) -> DataFrame:
    """(feature, importance) of a fitted tree model or (absolute) coefficients."""
    values = getattr(model, "featureImportances", None)
    values = values if values is not None else model.coefficients
    return spark.createDataFrame([(c, float(v)) for c, v in zip(columns, values.toArray(), strict=True)], "feature string, importance double")
