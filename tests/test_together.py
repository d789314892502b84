"""The stages of a feature pipeline learn the same together as one after the other."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import StringIndexer

from tallymark.operators import features as feats
from tallymark.operators import ordering
from tallymark.operators.together import FeaturePipeline, _Learned, _ranks


def table(spark, n=301, gaps=0.3, seed=5):
    rng = np.random.default_rng(seed)
    some = lambda v: None if rng.random() < gaps else v
    rows = [
        (
            i, some(float(rng.lognormal(1, 1))), float("nan") if rng.random() < gaps else float(rng.normal()),
            some(int(rng.integers(0, 4))), 7.0, some(["b", "a", "z z", "é", "\U0001f600", "￮"][int(rng.integers(0, 6))]), some(str(i % 2)),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(rows, "id long, x double, y double, k int, same double, kind string, two string").repartition(4)


def stages():
    return [
        feats.RatioFeatures([("r", "x", "k")]),
        *feats.route(["x", "r"], ["y", "k", "same"], ["kind", "two"]),
    ]


def learned(model):
    out = {(r.stage, r.feature, r.parameter): r.value for r in feats.fitted_parameters(model).collect()}
    labels = [labels for s in model.stages if hasattr(s, "labelsArray") for labels in s.labelsArray]
    return out, labels


def same(a, b):
    assert a.keys() == b.keys()
    for k, v in a.items():
        if k[2] == "mode":
            assert v == b[k]
        else:
            assert math.isclose(float(v), float(b[k]), rel_tol=1e-9, abs_tol=1e-12), (k, v, b[k])


@pytest.mark.parametrize("n, gaps, limits", [(301, 0.3, "plain"), (301, 0.7, "brackets"), (300, 0.0, "brackets"), (2, 0.0, "plain")])
def test_equals_one_after_the_other(spark, monkeypatch, n, gaps, limits):
    if limits == "brackets":
        monkeypatch.setattr(ordering, "WHOLE_ROWS", 10)
        monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 50)
    df = table(spark, n, gaps)
    if n == 2:
        df = df.fillna(1.0).fillna(1).fillna("a")
    together, apart = FeaturePipeline(stages=stages()).fit(df), Pipeline(stages=stages()).fit(df)
    (a, labels_a), (b, labels_b) = learned(together), learned(apart)
    same(a, b)
    assert labels_a == labels_b and feats.feature_names(together) == feats.feature_names(apart)
    left, right = (
        [r.features.toArray() for r in m.transform(df).orderBy("id").collect()] for m in (together, apart)
    )
    assert np.allclose(left, right, rtol=1e-8, atol=1e-9)


def test_ranks_of_filled_columns():
    for n in range(1, 8):
        values = np.arange(n) * 10.0
        for copies in range(6):
            filled = np.sort([*values, *[np.median(values)] * copies])
            for rank, want in enumerate(filled):
                raw = _Learned._place(rank, n, n + copies)
                assert (np.median(values) if raw is None else values[raw]) == want
        for q in (0.0, 0.25, 0.5, 0.9, 1.0):
            low, high, part = _ranks(q, n)
            assert math.isclose(values[low] + (values[high] - values[low]) * part, np.quantile(values, q), abs_tol=1e-12)


def test_in_place_unknown_stages_and_second_powers(spark):
    df = table(spark)
    def each():
        return [
            feats.MedianImputer(["x", "k"]), feats.RobustScale(["x"]), feats.RobustScale(["x"]),
            feats.YeoJohnson(["k"]), feats.YeoJohnson(["k"]), feats.RobustScale(["k", "y"], lower=0.1, upper=0.8),
            feats.ModeImputer(["kind"]), feats.RatioFeatures([("z", "x", "k")]), feats.MedianImputer(["z"]),
            StringIndexer(inputCol="kind", outputCol="code", handleInvalid="keep"),
        ]
    (a, _), (b, _) = (learned(p(stages=each()).fit(df)) for p in (FeaturePipeline, Pipeline))
    same(a, b)


def test_empty_columns_raise_and_no_stages_pass(spark):
    df = table(spark).selectExpr("id", "double(null) AS x", "double('NaN') AS y", "string(null) AS kind")
    for stage in (feats.MedianImputer(["x"]), feats.MedianImputer(["y"]), feats.RobustScale(["x"]), feats.ModeImputer(["kind"])):
        with pytest.raises(ValueError, match="no value to learn"):
            FeaturePipeline(stages=[stage]).fit(df)
        with pytest.raises(ValueError, match="no value to learn"):
            FeaturePipeline(stages=[stage]).fit(df.limit(0))
    assert FeaturePipeline(stages=[]).fit(df).stages == []


def test_saved_and_loaded(spark, tmp_path):
    from pyspark.ml import PipelineModel

    df = table(spark)
    model = FeaturePipeline(stages=stages()).fit(df)
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.transform(df).orderBy("id").first().features == model.transform(df).orderBy("id").first().features


def test_shared_passes(spark):
    """Counting and ranks: a handful of jobs, whatever the number of columns and stages."""
    df, status = table(spark).checkpoint(), spark.sparkContext.statusTracker()

    def jobs(pipe, group):
        spark.sparkContext.setJobGroup(group, group)
        pipe(stages=feats.route([], ["x", "y", "k"], ["kind", "two"])).fit(df)
        return len(status.getJobIdsForGroup(group))

    together, apart = jobs(FeaturePipeline, "together"), jobs(Pipeline, "apart")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert together <= 6 and together < apart
