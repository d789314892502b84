"""Coefficients, per-row contributions and typed errors of a linear classifier."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.columns import outcome_type
from tallymark.operators.ordering import local_frame


def coefficient_table(coefficients: Sequence[float], names: Sequence[str]) -> DataFrame:
    """``feature, coefficient, odds_ratio, abs_coefficient``, the strongest first."""
    rows = [
        {
            "feature": n, "coefficient": float(c), "odds_ratio": math.exp(c) if c < 709 else math.inf,
            "abs_coefficient": abs(float(c)),
        }
        for n, c in zip(names, coefficients, strict=True)
    ]
    schema = T.StructType.fromDDL(
        "feature string, coefficient double, odds_ratio double, abs_coefficient double"
    )
    table = local_frame(SparkSession.active(), rows, schema)
    return table.orderBy(F.desc("abs_coefficient"), "feature")


def top_coefficients(table: DataFrame, n: int = 10) -> DataFrame:
    """The n strongest, ordered by signed value."""
    strongest = table.orderBy(F.desc("abs_coefficient"), "feature").limit(n)
    return strongest.orderBy("coefficient", "feature")


def feature_array(df: DataFrame, features: str) -> Column:
    """The feature vector as an array, whether it is stored as a vector or already an array."""
    if isinstance(df.schema[features].dataType, T.ArrayType):
        return F.col(features)
    return vector_to_array(features)


def contributions(
    df: DataFrame, coefficients: Sequence[float], intercept: float, features: str = "features"
) -> DataFrame:
    """Adds ``contributions`` (value times coefficient per slot) and their sum with the intercept,
    ``contribution_sum``. Slot expressions are generated, so they run inside compiled code."""
    values = feature_array(df, features)
    parts = [values[i] * F.lit(float(c)) for i, c in enumerate(coefficients)]
    total = F.lit(float(intercept))
    for i in range(len(parts)):
        total = total + F.col("contributions")[i]
    return df.withColumn("contributions", F.array(*parts)).withColumn("contribution_sum", total)


def additivity_check(contributed: DataFrame, decision: str | Column) -> DataFrame:
    """Largest distance between the model's decision value and the summed contributions."""
    value = F.col(decision) if isinstance(decision, str) else decision
    return contributed.agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.abs(value - F.col("contribution_sum"))).alias("max_difference"),
    )


def extreme_contributions(
    contributed: DataFrame, names: Sequence[str], keys: Sequence[str], count: int = 6
) -> DataFrame:
    """For every row its lowest and highest ``count // 2`` contributions, lowest first:
    ``keys…, place, feature, contribution``."""
    half = count // 2
    labelled = F.array(
        *[
            F.struct(F.col("contributions")[i].alias("contribution"), F.lit(n).alias("feature"))
            for i, n in enumerate(names)
        ]
    )
    low = min(half, len(names))
    ordered = F.sort_array(labelled)
    ends = F.concat(
        F.slice(ordered, 1, low), F.slice(ordered, len(names) - low + 1, low)
    )
    return contributed.select(*keys, F.posexplode(ends).alias("place", "c")).select(
        *keys, (F.col("place") + 1).cast("bigint").alias("place"), "c.feature", "c.contribution"
    )


def type_errors(df: DataFrame, y: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.withColumn("error_type", outcome_type(y, prediction))


def outcome_counts(df: DataFrame, column: str = "error_type") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), column)


def misclassified(df: DataFrame, probability: str = "score") -> DataFrame:
    """False positives and false negatives, least probable first."""
    wrong = F.col("error_type").isin("False positive", "False negative")
    return df.filter(wrong).orderBy(probability)
