"""The three flows on invented clinical rows: profile, train, score."""

from functools import partial

import numpy as np

from tallymark.operators import features as feats
from tallymark.operators import models
from tallymark.operators import prepare as prep
from tallymark.plans import flows
from tallymark.session import scratch_path
from tallymark.sources.ingest import load_artifact
from tallymark.spec import CLINICAL

LABS = [c for c in CLINICAL.raw_features if c not in ("Age", "Gender")]
RAW_LABS = [c for c in LABS if c in CLINICAL.columns]


def test_profile_train_and_score(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(160):
        sick = rng.random() < 0.6
        labs = [f"{v:.6f}" for v in rng.lognormal(0.9 if sick else 0.0, 0.5, len(RAW_LABS))]
        rows.append((str(int(rng.integers(4, 90))), str(rng.choice(["Male", "Female"])), *labs, "?" if i % 40 == 0 else ("1" if sick else "2"), None))
    rows += rows[:10]
    names = ["Age", "Gender", *RAW_LABS, CLINICAL.target if CLINICAL.target in CLINICAL.columns else "Dataset", "extra"]
    schema = ", ".join(f"{n} string" for n in names)
    csv = scratch_path(spark, "raw")
    spark.createDataFrame(rows, schema).write.option("header", True).csv(csv)
    found = flows.profile(spark, csv, CLINICAL, scratch_path(spark, "layers"), "patients")
    assert found.table.count() == 170 and {r["metric"]: r["count"] for r in found.summary.collect()}["Missing target"] >= 4
    assert found.numbers.count() > 5 and found.nulls.count() >= 1

    table = prep.prepare_supervised(found.table, CLINICAL)
    names = [c for c in table.columns if c != "label"]
    keyed = table.selectExpr("*", f"md5(concat_ws('|', {', '.join(names)})) AS id")
    parts = prep.stratified_split(keyed, "label", "id")
    train, test = (parts.filter(f"split = '{s}'").drop("split").persist() for s in ("train", "test"))
    catalog = {
        "logistic_regression": models.Family("logistic_regression", {"C": 1.0, "weight": "balanced", "max_iter": 30}),
        "decision_tree": models.Family("decision_tree", {"depth": 2, "weight": "balanced"}),
    }
    grids = {"logistic_regression": {"C": [0.1, 1.0]}, "decision_tree": {"depth": [1, 2]}}
    path = scratch_path(spark, "model")
    done = flows.train(
        catalog, grids, partial(feats.feature_stages, CLINICAL), train, test, "id", path,
        target_mapping=CLINICAL.target_map, folds=2, outer=2, inner=2,
    )
    assert done.comparison.count() == 3 and set(done.shortlisted) <= set(catalog) and done.selected in done.shortlisted
    assert done.nested.count() == 2 * len(done.shortlisted)
    assert done.tests is None or done.tests.count() == len(done.shortlisted) - 1
    _, meta = load_artifact(spark, path)
    assert meta == done.metadata and set(meta) == {"model_name", "best_params", "target_mapping", "selection_metric", "test_metrics"}
    assert meta["test_metrics"]["balanced_accuracy"] > 0.5
    requests = test.select(*CLINICAL.raw_features).limit(5)
    scored, rejected = flows.score_requests(path, requests, CLINICAL)
    assert scored.count() + rejected.count() == 5 and "predicted_label" in scored.columns
