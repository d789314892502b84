"""Scoring saved or fitted models on raw rows."""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.columns import map_values
from tallymark.operators.models import positive_score
from tallymark.operators.quality import validate
from tallymark.sources.ingest import ArtifactMissing, SourceUnreadable, load_artifact
from tallymark.spec import TableSpec


def score(model: PipelineModel, df: DataFrame, labels: Mapping[int, str] | None = None) -> DataFrame:
    """Raw columns plus ``predicted``, ``score``, ``probability_1`` and, if named, ``predicted_label``.

    ``score`` is always there; ``probability_1`` is null for a model without probabilities.
    """
    scored = positive_score(model.transform(df))
    code = F.col("prediction").cast("bigint")
    shown = [map_values(code, dict(labels)).alias("predicted_label")] if labels else []
    return scored.select(
        *df.columns, code.alias("predicted"), "score", "probability_1", *shown
    )


def contract_rules(spec: TableSpec) -> dict[str, Column]:
    """Accepted ranges and categories of the inputs as named row conditions."""
    rules = {}
    for c, bound in spec.bounds.items():
        value = F.col(c).cast("double")
        if bound.low is not None:
            rules[f"{c} >= {bound.low:g}"] = value >= float(bound.low)
        if bound.high is not None:
            rules[f"{c} <= {bound.high:g}"] = value <= float(bound.high)
    for c, values in spec.domains.items():
        rules[f"{c} in {list(values)}"] = F.col(c).isin(list(values))
    return rules


def check_contract(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Requests that can be scored, and rejected ones with the rules they break.

    An absent column is an error of the whole request.
    """
    absent = [c for c in spec.raw_features if c not in df.columns]
    if absent:
        raise SourceUnreadable(f"missing columns {absent}")
    _, valid, rejected = validate(df, contract_rules(spec))
    return valid, rejected


_MODELS: OrderedDict[tuple, PipelineModel] = OrderedDict()


def cached_model(path: str, most: int = 8) -> PipelineModel:
    """Load a saved model once per session, and again after it was saved anew; the last ``most`` are kept."""
    spark = SparkSession.active()
    try:
        files = spark.read.format("binaryFile").load(f"{path}/metadata").select("path", "modificationTime")
        saved = tuple(sorted(map(tuple, files.collect())))
    except AnalysisException as error:
        raise ArtifactMissing(f"no model at {path}") from error
    key = (spark.sparkContext.applicationId, path, saved)
    if key not in _MODELS:
        _MODELS[key] = load_artifact(spark, path)[0]
    _MODELS.move_to_end(key)
    while len(_MODELS) > most:
        _MODELS.popitem(last=False)
    return _MODELS[key]
