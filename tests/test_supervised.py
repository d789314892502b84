"""Splits, fitted stages, metrics, models, selection, interpretation and scoring."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallymark.functions import distributions as dist
from tallymark.operators import features as feats
from tallymark.operators import interpret
from tallymark.operators import metrics as met
from tallymark.operators import models
from tallymark.operators import ordering
from tallymark.operators import prepare as prep
from tallymark.operators.paired import paired_tests
from tallymark.plans import diagnostics as diag
from tallymark.plans import scoring
from tallymark.plans import selection as sel
from tallymark.sources.ingest import load_artifact, save_artifact
from tallymark.spec import CLINICAL
from tallymark.streaming import scoring as live

LABS = [c for c in CLINICAL.raw_features if c not in ("Age", "Gender")]


@pytest.fixture(scope="module")
def patients(spark):
    """Invented clinical rows with missing cells, copies and missing targets."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(240):
        sick = rng.random() < 0.7
        labs = [float(v) for v in rng.lognormal(0.6 if sick else 0.0, 0.7, len(LABS))]
        if i % 17 == 0:
            labs[7] = None
        if i % 29 == 0:
            labs[0] = 0.0
        rows.append(
            (i, int(rng.integers(4, 90)), str(rng.choice(["Male", "Female"])), *labs,
             None if i % 40 == 0 else (1 if sick else 2))
        )
    rows += [(1000 + i, *rows[i][1:]) for i in range(30)]
    names = ", ".join(f"{c} double" for c in LABS)
    return spark.createDataFrame(rows, f"id long, Age long, Gender string, {names}, Diagnosis long")


@pytest.fixture(scope="module")
def spec():
    import dataclasses

    return dataclasses.replace(CLINICAL, key="id")


@pytest.fixture(scope="module")
def table(patients, spec):
    return prep.prepare_supervised(patients, spec).persist()


def test_supervised_table(table):
    assert "Diagnosis" not in table.columns
    assert table.filter("label is null").count() == 0
    assert table.count() == table.drop("id").distinct().count() == 234
    assert {r[0] for r in table.select("label").distinct().collect()} == {0, 1}


def test_unknown_target_is_an_error(spark):
    bad = spark.createDataFrame([(1,), (3,)], "y long")
    with pytest.raises(Exception, match="target domain"):
        prep.encode_target(bad, "y", {1: 1, 2: 0}).collect()
    with pytest.raises(ValueError, match="outside"):
        prep.assert_target_domain(bad, "y", [1, 2])


@pytest.mark.parametrize("leaf", [200_000, 5])
def test_split_and_folds(table, monkeypatch, leaf):
    monkeypatch.setattr(ordering, "LEAF_ROWS", leaf)
    rows = prep.stratified_split(table, "label", "id")
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    assert test.count() == math.ceil(0.2 * table.count())
    assert train.select("id").intersect(test.select("id")).count() == 0
    assert train.drop("split").unionByName(test.drop("split")).exceptAll(table).count() == 0
    share = table.agg(F.avg("label")).first()[0]
    assert abs(test.filter("label = 1").count() - share * test.count()) <= 1
    folds = prep.stratified_folds(table, "label", "id", 5)
    sizes = folds.groupBy("label").pivot("fold", [1, 2, 3, 4, 5]).count().collect()
    for r in sizes:
        assert max(r[1:]) - min(r[1:]) <= 1
    hashed = prep.stratified_split(table, "label", "id", mode="hash")
    assert {r[0] for r in hashed.select("split").distinct().collect()} == {"train", "test"}


def test_allocation_prefers_the_largest_remainder():
    assert prep.allocate({0: 7, 1: 3}, 0.25) == {0: 2, 1: 1}
    assert prep.allocate({}, 0.2) == {}


def test_power_lambda_is_the_maximum(spark):
    rng = np.random.default_rng(2)
    x, z = rng.lognormal(0, 0.9, 400), rng.normal(-1, 2, 400)
    df = spark.createDataFrame([(float(a), float(b), 3.0) for a, b in zip(x, z)], "x double, z double, c double")
    model = feats.YeoJohnson(["x", "z", "c"]).fit(df)
    lams = model.getOrDefault(model.lambdas)

    def transform(v, lam):
        out = np.empty_like(v)
        up = v >= 0
        out[up] = np.log1p(v[up]) if lam == 0 else ((v[up] + 1) ** lam - 1) / lam
        m = 2 - lam
        out[~up] = -np.log1p(-v[~up]) if m == 0 else -((1 - v[~up]) ** m - 1) / m
        return out

    def likelihood(v, lam):
        return -v.size / 2 * np.log(transform(v, lam).var()) + (lam - 1) * (np.sign(v) * np.log1p(abs(v))).sum()

    for v, lam in zip((x, z), lams):
        scan = np.linspace(lam - 0.5, lam + 0.5, 2001)
        best = scan[np.argmax([likelihood(v, s) for s in scan])]
        assert abs(best - lam) <= 1e-3
        assert likelihood(v, lam) >= likelihood(v, best) - 1e-6
    assert lams[2] == 1.0
    got = [r[0] for r in model.transform(df).select("z").collect()]
    assert np.allclose(got, transform(z, lams[1]))


def test_power_lambda_leaves_the_first_grid_if_needed(spark):
    x = np.random.default_rng(4).normal(50, 1.0, 300) ** 0.125  # needs a large lambda
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    model = feats.YeoJohnson(["x"]).fit(df)
    assert model.getOrDefault(model.lambdas)[0] > 4.0


def test_robust_scale_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "x double")
    model = feats.RobustScale(["x"]).fit(df)
    assert model.transform(spark.createDataFrame([(9.0,)], "x double")).first()[0] == 4.0


def test_unseen_category_is_all_zeros(spark):
    train = spark.createDataFrame([("a",), ("b",)], "g string")
    new = spark.createDataFrame([("b",), ("z",), (None,)], "g string")
    model = Pipeline(stages=feats.one_hot(["g"])).fit(train)
    got = [list(r[0]) for r in model.transform(new).select(vector_to_array("g__hot")).collect()]
    assert got == [[0.0, 1.0], [0.0, 0.0], [0.0, 0.0]]


def test_features_learn_from_train_only(table, spec):
    rows = prep.stratified_split(table, "label", "id")
    train = rows.filter("split = 'train'").drop("split")
    test = rows.filter("split = 'test'").drop("split")
    a, b, names = feats.fit_transform(feats.build_feature_pipeline(spec), train, test)
    assert names == [*spec.skewed, *spec.regular, "Gender_Female", "Gender_Male"]
    assert prep.null_audit(b, "features", names).filter("nulls > 0").count() == 0
    again = feats.build_feature_pipeline(spec).fit(train)
    one = feats.fitted_parameters(again).collect()
    spoiled = rows.withColumn("Albumin", F.when(F.col("split") == "test", 1e9).otherwise(F.col("Albumin")))
    other = feats.build_feature_pipeline(spec).fit(spoiled.filter("split = 'train'").drop("split"))
    assert feats.fitted_parameters(other).collect() == one
    assert set(train.columns) < set(a.columns)


def scored(spark, rows):
    return spark.createDataFrame(
        [(int(y), float(s), float(s >= 0.5)) for y, s in rows], "label int, score double, prediction double"
    )


def brute(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(p >= t for p in pos)
        ap += (tp / len(pos) - seen) * tp / (tp + sum(n >= t for n in neg))
        seen = tp / len(pos)
    return auc, ap


@pytest.mark.parametrize("limit", [1_000_000, 20])
def test_ranking_metrics_with_ties(spark, monkeypatch, limit):
    monkeypatch.setattr(ordering, "BUCKET_ROWS", limit)
    rng = np.random.default_rng(8)
    rows = [(rng.random() < 0.4, round(float(rng.random()), 2)) for _ in range(300)]
    df = scored(spark, rows)
    auc, ap = brute(rows)
    got = met.evaluate(df).first()
    assert math.isclose(got["roc_auc"], auc) and math.isclose(got["average_precision"], ap)
    theirs = BinaryClassificationEvaluator(rawPredictionCol="score").evaluate(df)
    assert math.isclose(got["roc_auc"], theirs)
    assert math.isclose(met.roc_auc(df).first()[0], auc)
    assert math.isclose(met.average_precision(df).first()[0], ap)


def test_metrics_with_one_class(spark):
    got = met.evaluate(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert got["roc_auc"] is None and got["precision"] == got["recall"] == got["f1"] == 0.0
    assert got["specificity"] == got["balanced_accuracy"] == 1.0
    report = {r["class"]: r for r in met.classification_report(scored(spark, [(1, 0.9), (0, 0.8), (1, 0.1)])).collect()}
    assert report["1"]["precision"] == 0.5 and report["accuracy"]["f1"] == pytest.approx(1 / 3)
    assert report["weighted avg"]["support"] == 3


def test_logistic_equals_newton(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(150, 2))
    y = (rng.random(150) < 1 / (1 + np.exp(-(x @ [1.0, -2.0] + 0.3)))).astype(float)
    weights = np.where(y == 1, 150 / (2 * y.sum()), 150 / (2 * (150 - y.sum())))
    beta = np.zeros(3)
    a, ridge = np.c_[x, np.ones(150)], np.diag([1.0, 1.0, 0.0]) / 0.5  # C = 0.5
    for _ in range(50):
        p = 1 / (1 + np.exp(-a @ beta))
        grad = a.T @ (weights * (p - y)) + ridge @ beta
        beta -= np.linalg.solve(a.T @ (a * (weights * p * (1 - p))[:, None]) + ridge, grad)
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(r), float(t)) for r, t in zip(x, y)], ["features", "label"])
    fit = models.Family("logistic_regression", {"C": 0.5, "weight": "balanced", "tol": 1e-10}).fit(df)
    assert np.allclose([*fit.coefficients, fit.intercept], beta, atol=1e-4)


def test_random_fourier_approximates_the_kernel(spark):
    from pyspark.ml.linalg import Vectors

    x = np.random.default_rng(1).normal(size=(6, 3))
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["features"])
    z = np.array(
        [r[0] for r in models.RandomFourier(slots=3, size=8000, gamma=0.3).transform(df)
         .select(vector_to_array("rff")).collect()]
    )
    kernel = np.exp(-0.3 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - kernel).max() < 0.06


@pytest.fixture(scope="module")
def fitted(table, spec):
    rows = prep.stratified_split(table, "label", "id")
    train = rows.filter("split = 'train'").drop("split")
    test = rows.filter("split = 'test'").drop("split").persist()
    from functools import partial

    stages = partial(feats.feature_stages, spec)
    family = models.Family("logistic_regression", {"C": 1.0, "weight": "balanced", "max_iter": 50})
    return sel.fit_final(family, stages, train), train, test, stages, family


def test_save_load_and_stream_predict_the_same(spark, fitted, tmp_path):
    model, _, test, _, _ = fitted
    save_artifact(model, {"model_name": "lr", "best_params": {"C": 1.0}}, str(tmp_path / "m"))
    loaded, meta = load_artifact(spark, str(tmp_path / "m"))
    assert meta == {"model_name": "lr", "best_params": {"C": 1.0}}
    want = {r["id"]: (r["predicted"], r["score"]) for r in scoring.score(model, test).collect()}
    got = {r["id"]: (r["predicted"], r["score"]) for r in scoring.score(loaded, test).collect()}
    assert got == want
    test.write.parquet(str(tmp_path / "in"))
    stream = live.read_parquet_stream(spark, str(tmp_path / "in"), test.schema)
    live.score_stream(loaded, stream, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {r["id"]: (r["predicted"], r["score"]) for r in out} == want


def test_contributions_add_up(fitted):
    model, _, test, _, _ = fitted
    last, names = model.stages[-1], feats.feature_names(model)
    rows = interpret.contributions(model.transform(test), list(last.coefficients), last.intercept)
    check = interpret.additivity_check(rows, vector_to_array("rawPrediction")[1]).first()
    assert check["n"] == test.count() and check["max_difference"] < 1e-9
    ends = interpret.extreme_contributions(rows, names, ["id"], 6)
    assert ends.count() == 6 * test.count()
    first = rows.first()
    mine = [r["contribution"] for r in ends.filter(F.col("id") == first["id"]).orderBy("place").collect()]
    want = sorted(first["contributions"])
    assert mine == want[:3] + want[-3:]
    table = interpret.coefficient_table(list(last.coefficients), names)
    top = interpret.top_coefficients(table, 3).collect()
    assert [r["coefficient"] for r in top] == sorted(r["coefficient"] for r in top)


def test_contract_and_single_request(spark, fitted, spec):
    model, _, _, _, _ = fitted
    from tallymark.sources.ingest import SourceUnreadable, to_frame

    request = dict.fromkeys(LABS, 1.0) | {"Age": 45, "Gender": "Male"}
    kinds = "Age long, Gender string, " + ", ".join(f"{c} double" for c in LABS)
    frame = to_frame(spark, [request, {**request, "Age": 130}, {**request, "Gender": "x"}], kinds)
    valid, rejected = scoring.check_contract(frame, spec)
    assert valid.count() == 1
    broken = sorted(r["broken_rules"][0] for r in rejected.collect())
    assert broken == ["Age <= 120", "Gender in ['Male', 'Female']"]
    shown = scoring.score(model, valid, spec.labels).first()
    assert shown["predicted_label"] == spec.labels[shown["predicted"]]
    assert 0 < shown["score"] == shown["probability_1"] < 1
    with pytest.raises(SourceUnreadable):
        scoring.check_contract(frame.drop("Albumin"), spec)


def test_margin_model_has_no_probability(fitted):
    _, train, test, stages, _ = fitted
    for params in ({"C": 1.0, "max_iter": 10}, {"C": 1.0, "rff": 20, "max_iter": 10, "gamma": "auto"}):
        model = sel.fit_final(models.Family("svc", params), stages, train)
        out = scoring.score(model, test)
        assert out.filter("score is null").count() == 0
        assert out.filter("probability_1 is not null").count() == 0


def test_selection_end_to_end(fitted):
    _, train, test, stages, family = fitted
    folded = prep.stratified_folds(train, "label", "id", 2)
    catalog = {"dummy_baseline": models.DUMMY, "logistic_regression": family}
    scores = sel.score_frame(sel.cross_validate(catalog, stages, folded, train_scores=True))
    assert scores.count() == 2 * 2 * 2
    summary = sel.summarise_folds(scores)
    rows = {r["model"]: r for r in summary.collect()}
    assert rows["dummy_baseline"]["balanced_accuracy_mean"] == 0.5
    assert rows["logistic_regression"]["balanced_accuracy_mean"] > 0.5
    assert [r["model"] for r in sel.shortlist(summary).collect()] == ["logistic_regression"]
    nested = sel.nested_cv(
        {"logistic_regression": family}, {"logistic_regression": {"C": [0.1, 1.0]}}, stages,
        train, "id", outer=2, inner=2,
    )
    assert nested.count() == 2 and sel.nested_summary(nested).count() == 1
    curve = sel.learning_curve(family, stages, folded, "id", fractions=(0.5, 1.0)).collect()
    assert curve[0]["train_size"] < curve[1]["train_size"]
    model, chosen, parts = sel.finalise(
        family, {"C": [0.1, 1.0]}, stages, train, test, "id", inner=2
    )
    assert isinstance(model, PipelineModel) and chosen.params["C"] in (0.1, 1.0)
    assert [r["part"] for r in parts.collect()] == ["train", "test"]


def test_grid_order():
    assert sel.combinations({"a": [1, 2], "b": ["x", "y"]}) == [
        {"a": 1, "b": "x"}, {"a": 1, "b": "y"}, {"a": 2, "b": "x"}, {"a": 2, "b": "y"}
    ]


def test_tail_probabilities():
    for t in (0.0, 0.7, 2.776445, 12.0):
        theta = math.atan(t / 2)
        want = 1 - math.sin(theta) * (1 + math.cos(theta) ** 2 / 2)
        assert math.isclose(dist.t_two_sided(t, 4), want, abs_tol=1e-12)
        assert math.isclose(dist.t_two_sided(t, 1), 1 - 2 / math.pi * math.atan(t), abs_tol=1e-12)
    assert dist.t_two_sided(None, 4) is None and dist.t_two_sided(float("inf"), 3) == 0.0
    for n in (1, 5, 8):
        sums = [sum(r for r, s in zip(range(1, n + 1), signs) if s)
                for signs in itertools.product([0, 1], repeat=n)]
        for w in range(n * (n + 1) // 2 + 1):
            low = min(w, n * (n + 1) / 2 - w)
            want = min(1.0, 2 * sum(s <= low for s in sums) / len(sums))
            assert math.isclose(dist.signed_rank_two_sided(w, n, 0.0, False), want)
    assert dist.signed_rank_two_sided(0, 5, 0.0, False) == 0.0625


@pytest.mark.parametrize("limit", [1_000_000, 5])
def test_paired_tests(spark, monkeypatch, limit):
    monkeypatch.setattr(ordering, "BUCKET_ROWS", limit)
    a = [0.71, 0.74, 0.69, 0.80, 0.77]
    b = [0.70, 0.71, 0.67, 0.75, 0.70]
    rows = [("m", x, y) for x, y in zip(a, b)] + [("same", x, x) for x in a]
    rows += [("long", float(i), float((i * 7) % 40) + 0.25) for i in range(40)]
    got = {r["m"]: r for r in paired_tests(
        spark.createDataFrame(rows, "m string, a double, b double"), ["m"], "a", "b").collect()}
    d = np.subtract(a, b)
    t = d.mean() / (d.std(ddof=1) / math.sqrt(5))
    assert math.isclose(got["m"]["t"], t, rel_tol=1e-9)
    assert math.isclose(got["m"]["paired_t_pvalue"], dist.t_two_sided(t, 4), rel_tol=1e-9)
    assert got["m"]["wilcoxon_pvalue"] == 0.0625 and got["m"]["w_minus"] == 0.0
    assert got["same"]["t"] is None and got["same"]["wilcoxon_pvalue"] is None
    assert got["long"]["w_plus"] + got["long"]["w_minus"] == 40 * 41 / 2
    assert [got[m]["wilcoxon_method"] for m in ("m", "same", "long")] == ["exact", None, "normal"]
    frame = spark.createDataFrame(rows, "m string, a double, b double")
    exact = {r["m"]: r for r in paired_tests(frame, ["m"], "a", "b", "exact").collect()}
    normal = {r["m"]: r for r in paired_tests(frame, ["m"], "a", "b", "normal").collect()}
    assert exact["m"]["wilcoxon_pvalue"] == 0.0625 and exact["long"]["wilcoxon_method"] == "exact"
    assert abs(exact["long"]["wilcoxon_pvalue"] - normal["long"]["wilcoxon_pvalue"]) < 0.02
    assert normal["m"]["wilcoxon_method"] == "normal" and normal["m"]["wilcoxon_pvalue"] != 0.0625
    whole = paired_tests(spark.createDataFrame(rows[:5], "m string, a double, b double"), [], "a", "b")
    assert math.isclose(whole.first()["t"], t, rel_tol=1e-9)


def test_second_tier(spark, table):
    counts = table.groupBy("label").count().collect()
    over = diag.oversample(table, "label", "id")
    largest = max(r["count"] for r in counts)
    assert {r["count"] for r in over.groupBy("label").count().collect()} == {largest}
    assert over.filter("copy = 1").count() == table.count()
    rule = diag.quantile_rule(table, [("Total_Bilirubin", "above", 0.75), ("Albumin", "below", 0.25)])
    assert 0 < rule(table).filter("prediction = 1").count() < table.count()
    fenced = diag.without_outliers(table, ["Total_Bilirubin"])
    assert 0 < fenced.count() < table.count()
    df = scored(spark, [(i % 3 == 0, i / 60) for i in range(60)])
    curve = diag.calibrate(df).transform(df).orderBy("score").collect()
    assert all(x["calibrated"] <= y["calibrated"] + 1e-12 for x, y in zip(curve, curve[1:]))
    sweep = {r["threshold"]: r for r in met.threshold_sweep(df, [0.0, 0.5, 2.0]).collect()}
    assert sweep[0.0]["tp"] == 20 and sweep[2.0]["fn"] == 20 and sweep[0.5]["tp"] == 10


def test_drift_of_equal_and_shifted_windows(spark):
    rows = [(f"2024-01-0{1 + i // 50} 10:00:00", float(i % 10) if i < 50 else float(9), "a" if i < 50 else "z")
            for i in range(100)]
    df = spark.createDataFrame(rows, "t string, v double, c string").withColumn("t", F.to_timestamp_ntz("t"))
    profile = live.window_profile(df, "t", "v", "c", ["a"], [4.0])
    got = [r.asDict() for r in live.drift(profile, [0.5, 0.5]).orderBy("window_start").collect()]
    assert abs(got[0]["psi"]) < 1e-12 and got[0]["unseen_rate"] == 0.0
    assert got[1]["psi"] > 1 and got[1]["unseen_rate"] == 1.0
    assert str(got[0]["window_start"]) == "2024-01-01 00:00:00"
