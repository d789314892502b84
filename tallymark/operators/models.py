"""Classifier families on the assembled feature vector."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import quoted
from tallymark.operators.forest import ForestClassifier
from tallymark.operators.ordering import class_counts
from tallymark.operators.prepare import add_weights

SEED = 42
NO_DEPTH_LIMIT = 30  # the deepest tree the library grows


class _Labelled(Params, DefaultParamsReadable, DefaultParamsWritable):
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    rate = Param(Params._dummy(), "rate", "0/1 for the predicted class", TypeConverters.toFloat)


class MajorityClass(Estimator, _Labelled):
    """Always predicts the most frequent training label (the smaller one on ties)."""

    def __init__(self, labelCol: str = "label"):
        super().__init__()
        self._set(labelCol=labelCol)

    def _fit(self, df: DataFrame) -> MajorityClassModel:
        y = self.getOrDefault(self.labelCol)
        counts = {c: n for c, n in class_counts(df, y).items() if c is not None}
        best = min(counts, key=lambda c: (-counts[c], c))
        return MajorityClassModel()._set(labelCol=y, rate=float(best))


class MajorityClassModel(Model, _Labelled):
    def __init__(self):
        super().__init__()

    def _transform(self, df: DataFrame) -> DataFrame:
        p = self.getOrDefault(self.rate)
        pair = array_to_vector(F.array(F.lit(1.0 - p), F.lit(p)))
        return df.withColumns(
            {"rawPrediction": pair, "probability": pair, "prediction": F.lit(p)}
        )


class Scorecard(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A logistic model whose coefficients are given: columns times points plus a constant.

    A missing value counts as 0. It adds the columns that a fitted classifier adds.
    """

    columns = Param(Params._dummy(), "columns", "scored columns", TypeConverters.toListString)
    points = Param(Params._dummy(), "points", "coefficient of each column", TypeConverters.toListFloat)
    constant = Param(Params._dummy(), "constant", "intercept", TypeConverters.toFloat)

    def __init__(self, points: Mapping[str, float] | None = None, constant: float = 0.0):
        super().__init__()
        given = dict(points or {})
        self._set(columns=list(given), points=[float(v) for v in given.values()], constant=float(constant))

    def _transform(self, df: DataFrame) -> DataFrame:
        margin = F.lit(self.getOrDefault(self.constant))
        for c, v in zip(self.getOrDefault(self.columns), self.getOrDefault(self.points)):
            margin = margin + F.coalesce(F.col(quoted(c)).cast("double"), F.lit(0.0)) * F.lit(v)
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
        pair = lambda a, b: array_to_vector(F.array(a, b))
        return df.withColumns({
            "rawPrediction": pair(-margin, margin), "probability": pair(F.lit(1.0) - p, p), "prediction": F.when(margin > 0, 1.0).otherwise(0.0),
        })


def cosine_basis(slots: int, size: int, gamma: float, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Random directions and offsets of ``size`` cosine features of a kernel of width ``gamma``."""
    draw = np.random.default_rng(seed)
    directions = draw.normal(0.0, np.sqrt(2.0 * gamma), (slots, size))
    return directions, draw.uniform(0.0, 2.0 * np.pi, size)


class RandomFourier(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Random cosine features whose inner products approximate an RBF kernel.

    The matrix product runs vectorised over Arrow batches.
    """

    inputCol = Param(Params._dummy(), "inputCol", "vector column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "vector column", TypeConverters.toString)
    slots = Param(Params._dummy(), "slots", "size of the input vector", TypeConverters.toInt)
    size = Param(Params._dummy(), "size", "number of cosine features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the random directions", TypeConverters.toInt)

    def __init__(
        self,
        inputCol: str = "features",
        outputCol: str = "rff",
        slots: int = 1,
        size: int = 100,
        gamma: float = 1.0,
        seed: int = SEED,
    ):
        super().__init__()
        self._set(
            inputCol=inputCol, outputCol=outputCol, slots=slots, size=size, gamma=gamma, seed=seed
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        size = self.getOrDefault(self.size)
        directions, offsets = cosine_basis(self.getOrDefault(self.slots), size, self.getOrDefault(self.gamma), self.getOrDefault(self.seed))

        @F.pandas_udf("array<double>")
        def cosines(v: pd.Series) -> pd.Series:
            if v.empty:
                return pd.Series([], dtype=object)
            z = np.sqrt(2.0 / size) * np.cos(np.stack(v.to_numpy()) @ directions + offsets)
            return pd.Series(list(z))

        made = array_to_vector(cosines(vector_to_array(self.getOrDefault(self.inputCol))))
        return df.withColumn(self.getOrDefault(self.outputCol), made)


@dataclass(frozen=True)
class Family:
    """A model family with its parameters; ``fit`` needs ``label`` and ``features`` columns.

    ``weight='balanced'`` weighs classes inversely to their size in the given training rows.
    """

    name: str
    params: Mapping[str, Any] = field(default_factory=dict)

    def with_params(self, **changes: Any) -> Family:
        return Family(self.name, {**self.params, **changes})

    def fit(self, train: DataFrame, y: str = "label", counts: Mapping | None = None):
        counts = dict(counts or class_counts(train, y))
        rows = sum(counts.values())
        weight = None
        if self.params.get("weight") == "balanced":
            weight = "class_weight"
            train = add_weights(
                train, y, {c: rows / (len(counts) * n) for c, n in counts.items()}, weight
            )
        # balanced weights add up to the number of rows, so rows is the total weight either way
        estimator = BUILDERS[self.name](self.params, y, rows, weight, train)
        if isinstance(estimator, tuple):
            first, last = estimator
            return PipelineModel([first, last.fit(first.transform(train))])
        return estimator.fit(train)


def _weighted(kwargs: dict, weight: str | None) -> dict:
    return {**kwargs, "weightCol": weight} if weight else kwargs


def _majority(p, y, rows, weight, train):
    return MajorityClass(y)


def logistic(p, y, rows, weight, train):
    """L2 logistic regression; C weighs the summed loss, so regParam = 1 / (C * total weight)."""
    return LogisticRegression(
        **_weighted(
            {
                "labelCol": y, "regParam": 1.0 / (p.get("C", 1.0) * rows), "elasticNetParam": 0.0,
                "standardization": False, "maxIter": p.get("max_iter", 2000), "tol": p.get("tol", 1e-6),
            },
            weight,
        )
    )


def _grown(p, y, weight, trees: int, bagged: bool, library, **more):
    """Trees grown by the executors; ``library`` takes labels other than 0 and 1."""
    depth, leaf, bins = p.get("depth") or NO_DEPTH_LIMIT, p.get("leaf", 1), p.get("bins", 64)
    shared = {"labelCol": y, "maxDepth": depth, "minInstancesPerNode": leaf, "impurity": "gini", "seed": SEED, "maxBins": bins, "maxMemoryInMB": 512}
    return ForestClassifier(y, weight, trees, depth, leaf, bins, SEED, bagged=bagged, other=library(**_weighted({**shared, **more}, weight)))


def tree(p, y, rows, weight, train):
    return _grown(p, y, weight, 1, False, DecisionTreeClassifier)


def forest(p, y, rows, weight, train):
    trees = p.get("trees", 300)
    return _grown(p, y, weight, trees, True, RandomForestClassifier, numTrees=trees, featureSubsetStrategy="sqrt")


def linear_svm(p, y, rows, weight, train):
    """Linear margin, or an approximate RBF margin through ``rff`` random cosine features."""
    size = p.get("rff")
    svc = LinearSVC(
        **_weighted(
            {
                "labelCol": y, "regParam": 1.0 / (p.get("C", 1.0) * rows),
                "standardization": False, "maxIter": p.get("max_iter", 200),
                "featuresCol": "rff" if size else "features",
            },
            weight,
        )
    )
    if not size:
        return svc
    slots, variance = _vector_spread(train)
    return RandomFourier(slots=slots, size=size, gamma=kernel_width(p, slots, variance)), svc


def kernel_width(p, slots: int, variance: float) -> float:
    return 1.0 / slots if p.get("gamma", "scale") == "auto" else 1.0 / (slots * (variance or 1.0))


def _vector_spread(train: DataFrame, features: str = "features") -> tuple[int, float]:
    """Vector length and the variance over all of its entries, combined per slot in one pass."""
    entries = train.select(F.explode(vector_to_array(features)).alias("x"), F.size(
        vector_to_array(features)
    ).alias("d"))
    r = entries.agg(F.max("d"), F.var_pop("x")).first()
    return r[0], r[1]


def boosted(p, y, rows, weight, train):
    return GBTClassifier(
        **_weighted(
            {
                "labelCol": y, "maxDepth": p.get("depth", 3), "maxIter": p.get("trees", 20),
                "stepSize": p.get("rate", 0.1), "seed": SEED,
            },
            weight,
        )
    )


BUILDERS = {
    "dummy_baseline": _majority,
    "logistic_regression": logistic,
    "decision_tree": tree,
    "random_forest": forest,
    "svc": linear_svm,
    "gradient_boosting": boosted,
}

# The compared families and their initial parameters.
CATALOG = {
    "logistic_regression": Family("logistic_regression", {"C": 1.0, "weight": "balanced"}),
    "decision_tree": Family("decision_tree", {"weight": "balanced"}),
    "random_forest": Family("random_forest", {"trees": 300, "weight": "balanced"}),
    "svc": Family("svc", {"C": 1.0, "rff": 100, "gamma": "scale", "weight": "balanced"}),
}
DUMMY = Family("dummy_baseline")

# The parameter grids of the search.
GRIDS = {
    "logistic_regression": {"C": [0.01, 0.1, 1.0, 10.0], "weight": ["balanced", None]},
    "decision_tree": {
        "depth": [2, 3, 5, None], "leaf": [1, 5, 10], "weight": ["balanced", None],
    },
    "random_forest": {
        "trees": [200, 400], "depth": [None, 5, 10], "leaf": [1, 5], "weight": ["balanced", None],
    },
    "svc": {"C": [0.1, 1.0, 10.0], "gamma": ["scale", "auto"], "weight": ["balanced", None]},
}


def positive_score(df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1 if the model gives one, else its decision value; ``probability_1``
    is null in the second case."""
    if "probability" in df.columns:
        p = vector_to_array("probability")[1]
        return df.withColumns({out: p, "probability_1": p})
    return df.withColumns(
        {out: vector_to_array("rawPrediction")[1], "probability_1": F.lit(None).cast("double")}
    )
