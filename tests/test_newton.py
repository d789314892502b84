"""Batched logistic fits against one solver run a model."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallymark.operators import newton
from tallymark.operators.models import Family
from tallymark.plans import selection


def rows(seed, n, d=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * np.array([1.0, 3.0, 0.3, 1.0])[:d]
    y = rng.random(n) < 1 / (1 + np.exp(1.2 - x @ np.array([1.0, -0.5, 2.0, 0.0])[:d]))
    return [(float(b), Vectors.dense(a)) for a, b in zip(x, y)]


@pytest.fixture(params=[newton.WHOLE_BYTES, 0], ids=["whole", "steps"])
def way(request, monkeypatch):
    monkeypatch.setattr(newton, "WHOLE_BYTES", request.param)


@pytest.fixture(scope="module")
def frames(spark):
    return {g: spark.createDataFrame(rows(g, n), ["label", "features"]).repartition(3) for g, n in ((0, 400), (1, 90))}


def test_equal_to_single_fits(spark, frames):
    tasks = [newton.Task((g, c, b), g, 1 / c, (0.7, 1.9) if b else (1.0, 1.0)) for g in frames for c in (0.01, 1.0, 100.0) for b in (0, 1)]
    found = newton.fit_many(newton.grouped_rows(frames, "label"), tasks)
    for t in tasks:
        df = frames[t.group].withColumn("w", F.when(F.col("label") == 1, t.weights[1]).otherwise(t.weights[0]))
        total = df.agg(F.sum("w")).first()[0]
        solver = LogisticRegression(labelCol="label", weightCol="w", regParam=t.penalty / total, standardization=False, maxIter=5000, tol=1e-14)
        one = solver.fit(df)
        mine = found[t.name]
        assert np.allclose(mine.coefficients, one.coefficients.toArray(), atol=1e-6) and abs(mine.intercept - one.intercept) < 1e-6
        assert mine.steps < 20


def test_scores_are_those_of_the_model(spark, frames):
    tasks = [newton.Task(g, g, 1.0) for g in frames]
    data = newton.grouped_rows(frames, "label")
    found = newton.fit_many(data, tasks)
    scored = newton.score_many(data, tasks, found).collect()
    assert len(scored) == 490 and {r.task for r in scored} == {0, 1}
    assert all(0 < r.score < 1 and r.prediction == (r.score > 0.5) for r in scored)
    # with a free intercept the scores add up to the positives
    for k in (0, 1):
        mine = [r for r in scored if r.task == k]
        assert abs(sum(r.score for r in mine) - sum(r.y for r in mine)) < 1e-6


def test_separable_rows_and_huge_margins(spark):
    df = spark.createDataFrame([(float(i > 5), Vectors.dense([1000.0 * (i - 5.5)])) for i in range(12)], ["label", "features"])
    found = newton.fit_many(newton.grouped_rows({0: df}, "label"), [newton.Task("a", 0, 1e-3)])["a"]
    assert np.isfinite(found.coefficients).all() and found.coefficients[0] > 0
    with pytest.raises(ValueError):
        newton.fit_many(newton.grouped_rows({0: df.limit(0)}, "label"), [newton.Task("a", 0, 1.0)])


def grid_rows(spark):
    data = [(i, float(y), x, i % 3 + 1) for i, (y, x) in enumerate(rows(7, 240))]
    return spark.createDataFrame(data, ["id", "label", "features", "fold"])


def models():
    return {f"m{i}": Family("logistic_regression", {"C": c, "weight": w, "tol": 1e-12}) for i, (c, w) in enumerate([(0.05, None), (1.0, "balanced"), (10.0, None)])}


def test_cross_validation_equals_single_fits(spark, monkeypatch):
    df = grid_rows(spark)
    together = selection.cross_validate(models(), list, df, train_scores=True)
    monkeypatch.setattr(selection, "_batched", lambda m: False)
    apart = selection.cross_validate(models(), list, df, train_scores=True)
    key = lambda r: (r["model"], r["fold"], r["part"])
    assert len(together) == len(apart) == 18
    for a, b in zip(sorted(together, key=key), sorted(apart, key=key)):
        assert key(a) == key(b)
        assert all(a[m] == pytest.approx(b[m], abs=1e-9) for m in b if m not in ("fit_time", "model", "part"))


def jobs(spark, name, work):
    sc = spark.sparkContext
    sc.setJobGroup(name, "count", False)
    work()
    n = len(sc.statusTracker().getJobIdsForGroup(name))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return n


def test_jobs_grow_with_steps_not_models(spark, frames):
    data = newton.grouped_rows(frames, "label")
    few = jobs(spark, "one", lambda: newton.fit_many(data, [newton.Task(0, 0, 1.0)]))
    many = jobs(spark, "thirty", lambda: newton.fit_many(data, [newton.Task(i, i % 2, 1.0) for i in range(30)]))
    assert many <= few + 8


def test_one_class_falls_back(spark):
    df = grid_rows(spark).withColumn("label", F.when(F.col("fold") == 1, F.col("label")).otherwise(0.0))
    assert selection.fit_batch(models(), {0: {"train": df.filter("fold <> 1").select("label", "features")}}, "label") is None


def test_interleaved_groups_share_matrices(spark):
    import pyarrow as pa

    n, x = 999, np.arange(1998.0)
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(n) % 3 + 1), pa.array((np.arange(n) % 2).astype(float)), pa.ListArray.from_arrays(np.arange(0, 2 * n + 1, 2, np.int32), x)],
        names=["group", "y", "x"],
    )
    for part in (batch, batch.slice(30, 600)):
        blocks = list(newton._blocks([part]))
        assert [g for g, _, _ in blocks] == [1, 2, 3]  # was a block a row
        for g, y, v in blocks:
            first = int(v[0, 0]) // 2
            rows_of = np.arange(first, first + 3 * len(y), 3)
            assert (rows_of % 3 + 1 == g).all() and (y == rows_of % 2).all() and (v == np.c_[2 * rows_of, 2 * rows_of + 1, np.ones(len(y))]).all()


def test_packed_rows_are_whole(spark, monkeypatch):
    df = spark.range(0, 500, 1, 2).selectExpr("cast(id % 4 as int) AS group", "cast(id % 2 as double) AS y", "array(cast(id as double), -1D) AS x")
    monkeypatch.setattr(newton, "PACKED", 1 << 10)  # many small matrices
    found = [(r.group, *v) for r in newton._packed(df).collect() for v in np.frombuffer(r.x).reshape(-1, r.width)]
    assert sorted(found) == sorted((i % 4, float(i), -1.0, 1.0) for i in range(500))


def hinge_loss(df, w, b, penalty, weights):
    x, y = (np.array([v for v in c]) for c in zip(*[(r.features.toArray(), r.label) for r in df.collect()]))
    side, weight = np.where(y > 0, 1.0, -1.0), np.where(y > 0, weights[1], weights[0])
    return (weight * np.maximum(1 - side * (x @ w + b), 0)).sum() + 0.5 * penalty * (w**2).sum()


def test_margins_are_no_worse_than_the_solver(spark, frames, way):
    from pyspark.ml.classification import LinearSVC

    tasks = [newton.Task((g, c), g, 1 / c, w, True) for g, w in ((0, (0.7, 1.9)), (1, (1.0, 1.0))) for c in (0.1, 1.0, 10.0)]
    found = newton.fit_many(newton.grouped_rows(frames, "label"), tasks)
    for t in tasks:
        df = frames[t.group].withColumn("w", F.when(F.col("label") == 1, t.weights[1]).otherwise(t.weights[0]))
        total = df.agg(F.sum("w")).first()[0]
        one = LinearSVC(labelCol="label", weightCol="w", regParam=t.penalty / total, standardization=False, maxIter=200).fit(df)
        mine = found[t.name]
        theirs = hinge_loss(df, one.coefficients.toArray(), one.intercept, t.penalty, t.weights)
        assert hinge_loss(df, mine.coefficients, mine.intercept, t.penalty, t.weights) <= theirs * (1 + 1e-4)


def test_families_are_fitted_together(spark):
    """The share of jobs a fold is small, and every metric is that of fits of their own (forests draw, so they are compared loosely)."""
    df = grid_rows(spark).cache()
    mixed = {
        "none": Family("dummy_baseline"), "lr": Family("logistic_regression", {"C": 1.0, "weight": "balanced"}),
        "svc": Family("svc", {"C": 1.0, "rff": 20, "gamma": "scale", "weight": "balanced"}), "plain": Family("svc", {"C": 1.0}),
        "tree": Family("decision_tree", {"depth": 3, "weight": "balanced"}), "forest": Family("random_forest", {"trees": 20, "weight": "balanced"}),
    }
    found = {}
    n = jobs(spark, "mixed", lambda: found.update({(r["model"], r["fold"], r["part"]): r for r in selection.cross_validate(mixed, list, df, train_scores=True, parallelism=1)}))
    assert set(found) == {(m, i, p) for m in mixed for i in (1, 2, 3) for p in ("train", "test")}
    assert n < 350  # the solvers' passes alone were over 600
    for name in mixed:
        apart = {(r["fold"], r["part"]): r for r in selection.cross_validate({name: mixed[name]}, list, df, train_scores=True)}
        for (i, p), r in apart.items():
            close = 1e-6 if name in ("none", "lr", "tree") else 0.05
            assert found[name, i, p]["roc_auc"] == pytest.approx(r["roc_auc"], abs=close)
            assert found[name, i, p]["balanced_accuracy"] == pytest.approx(r["balanced_accuracy"], abs=close if name != "lr" else 0.02)


def test_both_ways_find_the_same_models(spark, frames, monkeypatch):
    tasks = [newton.Task((g, c, m), g, 1 / c, (1.0, 2.0), m) for g in frames for c in (0.1, 10.0) for m in (False, True)]
    data = newton.grouped_rows(frames, "label")
    whole = newton.fit_many(data, tasks)
    monkeypatch.setattr(newton, "WHOLE_BYTES", 0)
    monkeypatch.setattr(newton, "FEW_PARTS", 0)
    steps = newton.fit_many(data, tasks)
    for t in tasks:
        assert steps[t.name].loss == pytest.approx(whole[t.name].loss, rel=1e-5)
        assert np.allclose(steps[t.name].coefficients, whole[t.name].coefficients, atol=2e-2 if t.margin else 1e-6)
