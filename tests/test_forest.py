"""Forests that stay with the executors, against brute force and the library's forest."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallymark.operators import forest, models
from tallymark.operators.models import Family
from tallymark.sources.ingest import load_artifact, save_artifact

FAMILY = Family("random_forest", {"trees": 12, "weight": "balanced"})


def rows(seed, n, flip=0.1):
    rng = np.random.default_rng(seed)
    x = np.c_[rng.normal(size=(n, 3)), rng.integers(0, 4, (n, 1)), np.zeros((n, 1))]
    y = ((x[:, 0] + x[:, 1] > 0.5) ^ (x[:, 3] == 2)) ^ (rng.random(n) < flip)
    return [(i, float(b), Vectors.dense(a)) for i, (b, a) in enumerate(zip(y, x))]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(1, 1500), ["id", "label", "features"]).repartition(4).cache()


@pytest.fixture(scope="module")
def fresh(spark):
    return spark.createDataFrame(rows(2, 700), ["id", "label", "features"]).repartition(3).cache()


def scores(model, df):
    return {r["id"]: r["s"] for r in model.transform(df).select("id", vector_to_array("probability")[1].alias("s")).collect()}


def auc(found, df):
    y = {r["id"]: r["label"] for r in df.collect()}
    good, bad = ([s for i, s in found.items() if y[i] == c] for c in (1.0, 0.0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in good for b in bad])


def test_best_splits_equal_brute_force():
    rng = np.random.default_rng(0)
    for bins, groups, size in ((6, 3, 60), (8, 40, 120)):
        cell = np.sort(rng.integers(0, groups, size)) * bins + rng.integers(0, bins, size)
        cell = np.append(cell, np.arange(groups) * bins)  # every node has rows
        rng.shuffle(cell)
        n, y = rng.integers(1, 4, len(cell)).astype(float), rng.integers(0, 2, len(cell))
        stats = [n, n * 1.7 * (y == 0), n * 0.6 * (y == 1)]
        whole = [np.bincount(cell // bins, s, groups) for s in stats]
        for leaf in (1, 3):
            want = np.full(groups, -1.0)
            for g in range(groups):
                for c in range(bins):
                    sides = [[s[(cell // bins == g) & ((cell % bins <= c) == low)].sum() for s in stats] for low in (True, False)]
                    if min(sides[0][0], sides[1][0]) >= leaf:
                        gini = lambda a, b: (a + b) * (1 - (a * a + b * b) / (a + b) ** 2)
                        want[g] = max(want[g], gini(whole[1][g], whole[2][g]) - sum(gini(a, b) for _, a, b in sides))
            want[want < 1e-9] = -1.0
            for search in (forest._best_dense, forest._best_sorted):
                gain, cut = search(cell, stats, whole, bins, leaf)
                assert np.allclose(gain, want)
                left = [[s[(cell // bins == g) & (cell % bins <= cut[g])].sum() for g in range(groups)] for s in stats]
                assert np.allclose(forest._gains([np.array(v) for v in left], whole, leaf), want)


def test_tree_separates_what_can_be_separated():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(0, 16, (400, 4)).astype(np.uint8), axis=0)
    y, ones = rng.integers(0, 2, len(x)).astype(float), np.ones(len(x))
    plan = forest._Plan(16, 30, 1, 4, 7, bagged=False)
    nodes = forest._grow(x, y, ones, ones.astype(int), plan, 0, [1])
    assert (nodes["value"][forest._reach(nodes, x)] == y).all()
    flat = forest._grow(x, y, ones, ones.astype(int), plan, 28, [1])  # two levels are left
    assert len(flat) <= 7
    leaves = forest._grow(x, y, ones, ones.astype(int), forest._Plan(16, 30, 20, 4, 7), 0, [1])
    assert np.bincount(forest._reach(leaves, x))[leaves["feature"] < 0].min() >= 20


def test_cuts_are_quantiles():
    values, weights = np.arange(1000.0), np.ones(1000)
    assert len(forest._cuts(values, weights, 64)) == 63
    assert np.abs(np.diff(forest._cuts(values, weights, 64)) - 1000 / 64).max() <= 1
    assert forest._cuts(np.array([0.0, 1.0, 5.0]), np.ones(3), 64).tolist() == [0.5, 3.0]
    v, w = forest._compress(np.repeat(values, 3), np.ones(3000), 50)
    assert len(v) <= 50 and w.sum() == 3000 and w.max() <= 3000 / 50 + 3 and v[-1] == 999


def test_as_good_as_the_library(spark, table, fresh):
    mine = FAMILY.with_params(trees=60).fit(table)
    theirs = RandomForestClassifier(labelCol="label", numTrees=60, maxDepth=30, featureSubsetStrategy="sqrt", seed=42, maxBins=64).fit(table)
    a, b = auc(scores(mine, fresh), fresh), auc(scores(theirs, fresh), fresh)
    assert a > b - 0.01 and a > 0.85
    out = mine.transform(fresh).select("id", "prediction", vector_to_array("rawPrediction").alias("raw"), vector_to_array("probability").alias("p")).collect()
    assert len(out) == 700
    for r in out:
        assert sum(r.raw) == pytest.approx(60) and r.p[1] == pytest.approx(r.raw[1] / 60) and r.prediction == float(r.raw[1] > r.raw[0])


def test_nodes_do_not_come_to_the_driver(spark, table):
    model = FAMILY.fit(table)
    assert not isinstance(model, RandomForestClassificationModel)  # was all trees in the driver's heap
    assert set(model.nodes(spark).columns) == {"tree", "node", "nodes"} and model.nodes(spark).count() == 12
    assert max(len(str(v)) for v in model.extractParamMap().values()) < 10_000


def test_same_seed_same_forest(table, fresh):
    assert scores(FAMILY.fit(table), fresh) == scores(FAMILY.fit(table), fresh)


def test_slices_score_as_the_small_plan(spark, table, fresh, monkeypatch):
    model = FAMILY.fit(table)
    small = scores(model, fresh)
    monkeypatch.setattr(forest, "SMALL_BYTES", 0)
    assert scores(model, fresh) == pytest.approx(small)
    monkeypatch.setattr(forest, "BLOCK", 50)
    monkeypatch.setattr(forest, "WHOLE_ROWS", 120)  # many slices
    assert scores(model, fresh) == pytest.approx(small)
    assert model.transform(fresh.limit(0)).count() == 0


def test_large_tables_grow_the_same_kind_of_tree(spark, table, fresh, monkeypatch):
    """One tree that looks at all features of all rows is the same whether it is grown whole or in parts."""
    fit = lambda trees, bagged, leaf=1: forest.ForestClassifier("label", None, trees, 30, leaf, 64, 42, bagged=bagged).fit(table)
    whole, many = scores(fit(1, False), fresh), auc(scores(fit(20, True), fresh), fresh)
    monkeypatch.setattr(forest, "WHOLE_ROWS", 200)
    monkeypatch.setattr(forest, "BLOCK", 64)
    parts = fit(1, False)
    assert parts.nodes(spark).filter("node = -1").count() == 1 and parts.nodes(spark).count() > 6
    assert scores(parts, fresh) == pytest.approx(whole)
    assert abs(auc(scores(fit(20, True), fresh), fresh) - many) < 0.03
    monkeypatch.setattr(forest, "SMALL_BYTES", 0)
    assert scores(parts, fresh) == pytest.approx(whole)


def test_one_class_and_wide_nodes_without_a_split(spark, monkeypatch):
    same = spark.createDataFrame([(i, float(i % 2), Vectors.dense([1.0, 2.0])) for i in range(300)], ["id", "label", "features"])
    pure = same.withColumn("label", F.lit(1.0))
    for limit in (forest.WHOLE_ROWS, 50):
        monkeypatch.setattr(forest, "WHOLE_ROWS", limit)
        fit = lambda df: forest.ForestClassifier("label", None, 3, 30, 1, 64, 42).fit(df)
        assert set(scores(fit(pure), pure).values()) == {1.0}
        found = set(scores(fit(same), same).values())
        assert len(found) == 1 and 0.3 < found.pop() < 0.7


def test_saved_forest_scores_the_same(spark, table, fresh, tmp_path):
    model = PipelineModel([FAMILY.fit(table)])
    save_artifact(model, {"model_name": "forest"}, str(tmp_path / "m"))
    loaded, _ = load_artifact(spark, str(tmp_path / "m"))
    assert scores(loaded, fresh) == scores(model, fresh)


def test_other_labels_get_the_library_forest(spark):
    df = spark.createDataFrame([(float(i % 3), Vectors.dense([float(i % 3), 1.0])) for i in range(60)], ["label", "features"])
    assert isinstance(Family("random_forest", {"trees": 3}).fit(df), RandomForestClassificationModel)
    assert models.BUILDERS["random_forest"] is models.forest
