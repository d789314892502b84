"""Queries over model families, selection, interpretation, scoring and streaming."""

from __future__ import annotations

from functools import partial

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.columns import outcome_type
from tallymark.operators import features as feats
from tallymark.operators import interpret, newton
from tallymark.operators import metrics as met
from tallymark.operators import prepare as prep
from tallymark.operators.models import CATALOG, DUMMY, GRIDS, Family, MajorityClass, Scorecard, positive_score
from tallymark.operators.ordering import local_frame, order_stats, settle
from tallymark.operators.paired import mean_difference, paired_tests
from tallymark.plans import diagnostics as diag
from tallymark.plans import scoring
from tallymark.plans import selection as sel
from tallymark.plans.frames import (
    DOC_SPEC,
    DOCS_SQL,
    ORDERS_SQL,
    folds_sql,
    labelled_docs,
    landed_docs,
    scored_orders,
    split_sql,
)
from tallymark.plans.queries_profile import rounded
from tallymark.plans.queries_supervised import _CELLS, ranking_sql, rates_sql
from tallymark.plans.registry import query, table
from tallymark.session import scratch_path
from tallymark.sources.ingest import load_artifact, save_artifact, to_frame
from tallymark.spec import Bound, TableSpec
from tallymark.streaming import scoring as live

STAGES = partial(feats.feature_stages, DOC_SPEC)
LOGISTIC = Family("logistic_regression", {"C": 1.0, "weight": "balanced", "max_iter": 2000})


def _docs(spark, sf):
    return landed_docs(spark, sf).withColumnRenamed("quality", "label")


def _parts(spark, sf):
    rows = prep.stratified_split(_docs(spark, sf), "label", "doc_id")
    return rows.filter("split = 'train'").drop("split"), rows.filter("split = 'test'").drop("split")


def _folded(df, k=5):
    return prep.stratified_folds(df, "label", "doc_id", k)


# ------------------------------------------------------------------ families
_MAJORITY = (
    "(SELECT label FROM (SELECT {y} AS label, count(*) AS n FROM {t} GROUP BY 1) "
    "ORDER BY n DESC, label LIMIT 1)"
)


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + f"SELECT doc_id, quality AS label, {_MAJORITY.format(y='quality', t='s WHERE split = ' + chr(39) + 'train' + chr(39))} "
    "AS predicted, "
    f"{_MAJORITY.format(y='quality', t='s WHERE split = ' + chr(39) + 'train' + chr(39))}::DOUBLE AS score "
    "FROM s WHERE split = 'test'"
)
def majority_class(spark, sf):
    train, test = _parts(spark, sf)
    model = MajorityClass().fit(train.select("label"))
    return positive_score(model.transform(test)).select(
        "doc_id", "label", F.col("prediction").cast("bigint").alias("predicted"), "score"
    )


def _scored_test(spark, sf, family):
    train, test = _parts(spark, sf)
    model = sel.fit_final(family, STAGES, train)
    return scoring.score(model, test, DOC_SPEC.labels).withColumn("score", F.round("score", 6))


@query()
def logistic_regression(spark, sf):
    return _scored_test(spark, sf, LOGISTIC)


@query()
def decision_tree(spark, sf):
    return _scored_test(spark, sf, CATALOG["decision_tree"])


@query()
def random_forest(spark, sf):
    return _scored_test(spark, sf, CATALOG["random_forest"])


@query()
def linear_margin(spark, sf):
    return _scored_test(spark, sf, Family("svc", {"C": 1.0, "weight": "balanced"}))


@query()
def kernel_margin(spark, sf):
    """Margin over random cosine features in place of an RBF kernel."""
    return _scored_test(spark, sf, CATALOG["svc"])


@query()
def gradient_boosting(spark, sf):
    return _scored_test(spark, sf, Family("gradient_boosting", {"depth": 3}))


# ------------------------------------------------------------------ selection
_FOLDED = folds_sql(DOCS_SQL, "quality", "doc_id")


@query(
    f"WITH d AS (SELECT quality AS label, fold FROM ({_FOLDED})), "
    "c AS (SELECT f.fold, d.label, count(*) AS n FROM (SELECT DISTINCT fold FROM d) f JOIN d "
    "ON d.fold <> f.fold GROUP BY 1, 2), "
    "m AS (SELECT fold, label AS prediction FROM (SELECT *, row_number() OVER (PARTITION BY fold "
    "ORDER BY n DESC, label) AS rn FROM c) WHERE rn = 1), "
    f"e AS (SELECT fold, {_CELLS} FROM d JOIN m USING (fold) GROUP BY fold) "
    f"SELECT 'dummy_baseline' AS model, fold, {rates_sql()}, CASE WHEN tp + fn > 0 AND tn + fp > 0 "
    "THEN 0.5::DOUBLE END AS roc_auc, round(CASE WHEN tp + fn = 0 THEN 0 ELSE (tp + fn)::DOUBLE / "
    "(tp + fp + fn + tn) END, 6) AS average_precision FROM e"
)
def baseline_cross_validation(spark, sf):
    """The majority-class baseline refitted and measured on every fold."""
    folded = prep.stratified_folds(_docs(spark, sf).select("doc_id", "label"), "label", "doc_id")
    no_features = lambda: feats.route([], [], [])
    rows = sel.cross_validate({"dummy_baseline": DUMMY}, no_features, folded)
    out = sel.score_frame(rows).select("model", "fold", *met.METRICS, "specificity")
    return rounded(out, 6, *met.METRICS, "specificity")


@query()
def model_comparison(spark, sf):
    """Baseline and all four families on the same five folds: means and deviations (times are no result)."""
    train, _ = _parts(spark, sf)
    models = {"dummy_baseline": DUMMY, **CATALOG, "logistic_regression": LOGISTIC}
    return sel.compare_models(models, STAGES, _folded(train), train_scores=True).drop("fit_time_mean")


@query()
def fit_times(spark, sf):
    train, _ = _parts(spark, sf)
    rows = sel.cross_validate({"logistic_regression": LOGISTIC}, STAGES, _folded(train))
    times = sel.fold_fit_times(sel.score_frame(rows))
    return times.select("model", "fold", (F.col("fit_time") >= 0).alias("measured"))


# Simple price rules stand for models here, so that whole tables of fold scores have SQL.
_RULES = {"low": 100000, "middle": 250000, "high": 400000, "dummy_baseline": 0}


def _rule_scores(spark, sf):
    folds = prep.stratified_folds(scored_orders(spark, sf), "label", "o_orderkey")
    ruled = folds.select(
        "fold", "label", "score",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("model"),
                        F.when(F.col("o_totalprice") > limit, 1).otherwise(0).alias("prediction"),
                    )
                    for name, limit in _RULES.items()
                ]
            )
        ).alias("m"),
    ).select("fold", "label", "score", "m.*")
    made = met.evaluate(ruled, by=["model", "fold"])
    # one row per model and fold: as small as the score table of fitted models
    return settle(made.withColumns({"part": F.lit("test"), "fit_time": F.lit(0.0)})).frame


_RULED_SQL = (
    "SELECT fold, label, score, model, CASE WHEN o_totalprice > price THEN 1 ELSE 0 END AS prediction "
    f"FROM ({folds_sql(ORDERS_SQL.replace('AS prediction', 'AS guessed'), 'label', 'o_orderkey')}), "
    "(VALUES " + ", ".join(f"('{n}', {v})" for n, v in _RULES.items()) + ") v(model, price)"
)
_SCORES_SQL = (
    f"SELECT model, fold, {rates_sql(12)} FROM (SELECT model, fold, {_CELLS} FROM ({_RULED_SQL}) "
    "GROUP BY model, fold)"
)
_KEPT = ("accuracy", "balanced_accuracy", "precision", "recall", "f1")


@query(
    "SELECT model, "
    + ", ".join(
        f"round(avg({m}), 6) AS {m}_mean, round(stddev_pop({m}), 6) AS {m}_std" for m in _KEPT
    )
    + f" FROM ({_SCORES_SQL}) GROUP BY model"
)
def fold_summary(spark, sf):
    """Mean and population deviation over folds, best first."""
    out = sel.summarise_folds(_rule_scores(spark, sf), _KEPT).drop("fit_time_mean")
    return rounded(out, 6, *[c for c in out.columns if c != "model"])


@query(
    "SELECT model, round(b, 6) AS balanced_accuracy_mean FROM (SELECT *, avg(b) OVER () AS mean FROM "
    f"(SELECT model, avg(balanced_accuracy) AS b, avg(recall) AS r, avg(f1) AS f FROM ({_SCORES_SQL}) "
    "WHERE model <> 'dummy_baseline' GROUP BY model)) WHERE b >= mean ORDER BY b DESC, r DESC, f DESC, model LIMIT 3"
)
def shortlist(spark, sf):
    out = sel.shortlist(sel.summarise_folds(_rule_scores(spark, sf)))
    return rounded(out.select("model", "balanced_accuracy_mean"), 6, "balanced_accuracy_mean")


@query(
    "SELECT model, "
    + ", ".join(
        f"round(avg({m}), 6) AS {m}_mean, round(stddev_samp({m}), 6) AS {m}_std"
        for m in ("balanced_accuracy", "recall", "f1", "roc_auc")
    )
    + f" FROM (SELECT a.*, b.roc_auc FROM ({_SCORES_SQL}) a JOIN "
    f"({ranking_sql(_RULED_SQL, 'model, fold')}) b ON a.model = b.model AND a.fold = b.fold) GROUP BY model"
)
def nested_summary(spark, sf):
    """Mean and sample deviation of the four nested metrics."""
    out = sel.nested_summary(_rule_scores(spark, sf))
    return rounded(out, 6, *[c for c in out.columns if c != "model"])


_COMPARED_SQL = (
    f"WITH sc AS (SELECT model, fold, round(balanced_accuracy, 10) AS b FROM ({_SCORES_SQL})), "
    "pr AS (SELECT o.model, o.fold, m.b - o.b AS d FROM sc o JOIN sc m ON o.fold = m.fold "
    "WHERE m.model = 'middle' AND o.model <> 'middle'), "
    "ts AS (SELECT model, count(*) AS pairs, avg(d) AS md, "
    "CASE WHEN stddev_samp(d) > 0 THEN avg(d) / (stddev_samp(d) / sqrt(count(*))) END AS t "
    "FROM pr GROUP BY model), "
    "rk AS (SELECT model, d, rank() OVER (PARTITION BY model ORDER BY abs(d)) + (count(*) OVER "
    "(PARTITION BY model, abs(d)) - 1) / 2.0 AS r FROM pr WHERE d <> 0), "
    "wx AS (SELECT model, count(*) AS nz, sum(CASE WHEN d > 0 THEN r ELSE 0 END)::DOUBLE AS wp, "
    "sum(CASE WHEN d < 0 THEN r ELSE 0 END)::DOUBLE AS wm FROM rk GROUP BY model) "
)


@query(
    _COMPARED_SQL
    + "SELECT ts.model, pairs, round(md, 8) AS mean_difference, round(t, 4) AS t, "
    # the t distribution with four degrees of freedom has a closed form
    "round(1 - sin(atan(abs(t) / 2)) * (1 + pow(cos(atan(abs(t) / 2)), 2) / 2), 6) AS paired_t_pvalue, "
    "wp AS w_plus, wm AS w_minus, "
    "round((SELECT count(*) FROM (SELECT unnest(range(32)) AS m) WHERE (m & 1) + 2 * ((m >> 1) & 1) + "
    "3 * ((m >> 2) & 1) + 4 * ((m >> 3) & 1) + 5 * ((m >> 4) & 1) <= least(wp, wm)) / 16.0::DOUBLE, 6) "
    "AS wilcoxon_pvalue FROM ts JOIN wx ON ts.model = wx.model"
)
def paired_significance(spark, sf):
    """Fold scores of the selected rule against the others: t-test and exact signed-rank test."""
    scores = _rule_scores(spark, sf).select(
        "model", "fold", F.round("balanced_accuracy", 10).alias("balanced_accuracy")
    )
    out = paired_tests(sel.compare_to_best(scores, "middle"), ["model"], "selected", "other").drop("wilcoxon_method")
    return rounded(
        rounded(rounded(out, 8, "mean_difference"), 4, "t"), 6, "paired_t_pvalue", "wilcoxon_pvalue"
    )


_PAIRS_SQL = (
    "SELECT event_type, user_id, avg(value) FILTER (WHERE dayofmonth(ts) <= 15) AS a, "
    "avg(value) FILTER (WHERE dayofmonth(ts) > 15) AS b FROM events GROUP BY event_type, user_id"
)


def _user_pairs(spark, sf):
    """Mean value per user and event type in the first and the second half of the month."""
    early = F.dayofmonth("ts") <= 15
    return table(spark, sf, "events").groupBy("event_type", "user_id").agg(
        F.avg(F.when(early, F.col("value"))).alias("a"),
        F.avg(F.when(~early, F.col("value"))).alias("b"),
    )


@query(
    f"WITH pr AS (SELECT event_type, round(a, 6) - round(b, 6) AS d FROM ({_PAIRS_SQL}) WHERE a IS NOT NULL "
    "AND b IS NOT NULL), ts AS (SELECT event_type, count(*) AS pairs, round(avg(d), 6) AS mean_difference, "
    "round(avg(d) / (stddev_samp(d) / sqrt(count(*))), 4) AS t FROM pr GROUP BY 1), "
    "rk AS (SELECT event_type, d, rank() OVER (PARTITION BY event_type ORDER BY abs(d)) + (count(*) OVER "
    "(PARTITION BY event_type, abs(d)) - 1) / 2.0 AS r FROM pr WHERE d <> 0) "
    "SELECT ts.event_type, pairs, mean_difference, t, w_plus, w_minus FROM ts JOIN (SELECT event_type, "
    "sum(CASE WHEN d > 0 THEN r ELSE 0 END)::DOUBLE AS w_plus, sum(CASE WHEN d < 0 THEN r ELSE 0 END)::DOUBLE "
    "AS w_minus FROM rk GROUP BY 1) w ON ts.event_type = w.event_type"
)
def paired_statistics(spark, sf):
    pairs = _user_pairs(spark, sf).withColumns({c: F.round(c, 6) for c in "ab"})
    out = paired_tests(pairs, ["event_type"], "a", "b")
    return rounded(rounded(out, 6, "mean_difference"), 4, "t").select(
        "event_type", "pairs", "mean_difference", "t", "w_plus", "w_minus"
    )


@query(
    "SELECT event_type, count(a - b) AS pairs, round(avg(a - b), 6) AS mean_difference "
    f"FROM ({_PAIRS_SQL}) GROUP BY event_type"
)
def mean_differences(spark, sf):
    return rounded(mean_difference(_user_pairs(spark, sf), ["event_type"], "a", "b"), 6, "mean_difference")


@query()
def grid_search(spark, sf):
    """Results of every parameter combination; the best one is refitted on all training rows."""
    train, _ = _parts(spark, sf)
    grid = GRIDS["logistic_regression"]
    _, chosen, results = sel.grid_search(LOGISTIC, grid, STAGES, _folded(train, 4))
    schema = T.StructType.fromDDL(
        "combination bigint, params string, chosen boolean, balanced_accuracy double, recall double, "
        "f1 double, roc_auc double"
    )
    rows = [
        {
            **{n: r.get(n) for n in schema.names}, "params": str(r["params"]),
            "chosen": LOGISTIC.with_params(**r["params"]) == chosen,
        }
        for r in results
    ]
    return local_frame(spark, rows, schema)


@query()
def nested_validation(spark, sf):
    """The whole grid of the selected family, four inner folds in each of five outer ones (165 fits)."""
    train, _ = _parts(spark, sf)
    return sel.nested_cv(
        {"logistic_regression": LOGISTIC}, GRIDS, STAGES, train, "doc_id"
    )


@query()
def learning_curve(spark, sf):
    train, _ = _parts(spark, sf)
    return sel.learning_curve(
        LOGISTIC, STAGES, _folded(train), "doc_id"
    ).drop("fit_time_mean")


@query()
def final_evaluation(spark, sf):
    """Last search on the training rows and the single look at the test rows."""
    train, test = _parts(spark, sf)
    _, _, metrics = sel.finalise(LOGISTIC, GRIDS["logistic_regression"], STAGES, train, test, "doc_id")
    return metrics


# ------------------------------------------------------------------ interpretation
_COEF, _NAMES, _INTERCEPT = [0.02, -3.5, 4.0, 0.00001], ["quantity", "discount", "tax", "price"], -0.4
_COLS = ["l_quantity", "l_discount", "l_tax", "l_extendedprice"]


def _linear(spark, sf):
    """Line items with fixed coefficients, so that contributions have SQL."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.array(*_COLS).alias("features"),
    )
    return interpret.contributions(lines, _COEF, _INTERCEPT)


_SUM_SQL = f"{_INTERCEPT}::DOUBLE" + "".join(
    f" + {c} * ({v!r})::DOUBLE" for c, v in zip(_COLS, _COEF)
)
_TYPED_ERRORS_SQL = (
    "SELECT CASE WHEN y = 1 AND p = 1 THEN 'True positive' WHEN y = 0 AND p = 0 THEN 'True negative' "
    "WHEN y = 0 AND p = 1 THEN 'False positive' ELSE 'False negative' END AS error_type, * FROM "
    f"(SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, "
    f"CASE WHEN {_SUM_SQL} > 0.6 THEN 1 ELSE 0 END AS p, {_SUM_SQL} AS z FROM lineitem)"
)


@query(
    f"SELECT l_orderkey, l_partkey, l_linenumber, round({_SUM_SQL}, 8) AS contribution_sum, "
    + ", ".join(f"CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE round({c} * ({v!r})::DOUBLE, 8) END AS {n}" for c, v, n in zip(_COLS, _COEF, _NAMES))
    + " FROM lineitem"
)
def row_contributions(spark, sf):
    parts = [F.round(F.col("contributions")[i], 8).alias(n) for i, n in enumerate(_NAMES)]
    return _linear(spark, sf).select(
        "l_orderkey", "l_partkey", "l_linenumber",
        F.round("contribution_sum", 8).alias("contribution_sum"), *parts,
    )


_SORTED_SQL = "list_sort(list_value({})) AS ends".format(
    ", ".join(
        f"{{'contribution': CASE WHEN {c} = 0 THEN 0.0::DOUBLE ELSE round({c} * ({v!r})::DOUBLE, 8) END, "
        f"'feature': '{n}'}}"
        for c, v, n in zip(_COLS, _COEF, _NAMES)
    )
)


@query(
    "SELECT l_orderkey, l_partkey, l_linenumber, place, ends[CASE place WHEN 1 THEN 1 ELSE 4 END].feature "
    "AS feature, ends[CASE place WHEN 1 THEN 1 ELSE 4 END].contribution AS contribution FROM "
    f"(SELECT l_orderkey, l_partkey, l_linenumber, {_SORTED_SQL} FROM lineitem), "
    "(SELECT unnest([1::BIGINT, 2::BIGINT]) AS place)"
)
def extreme_contributions(spark, sf):
    """Lowest and highest contribution of every row."""
    keys = ["l_orderkey", "l_partkey", "l_linenumber"]
    out = interpret.extreme_contributions(_linear(spark, sf), _NAMES, keys, count=2)
    return rounded(out, 8, "contribution")


def _typed_errors(spark, sf):
    rows = _linear(spark, sf).withColumn(
        "prediction", F.when(F.col("contribution_sum") > 0.6, 1).otherwise(0)
    )
    return interpret.type_errors(rows)


@query(f"SELECT error_type, count(*) AS n FROM ({_TYPED_ERRORS_SQL}) GROUP BY 1")
def outcome_counts(spark, sf):
    return interpret.outcome_counts(_typed_errors(spark, sf))


@query(
    f"SELECT l_orderkey, l_partkey, l_linenumber, error_type, round(z, 8) AS score FROM ({_TYPED_ERRORS_SQL}) "
    "WHERE error_type IN ('False positive', 'False negative')"
)
def misclassified_rows(spark, sf):
    wrong = interpret.misclassified(_typed_errors(spark, sf), "contribution_sum")
    return wrong.select(
        "l_orderkey", "l_partkey", "l_linenumber", "error_type",
        F.round("contribution_sum", 8).alias("score"),
    )


def _fitted(spark, sf):
    train, test = _parts(spark, sf)
    model = sel.fit_final(LOGISTIC, STAGES, train)
    names = feats.feature_names(model)
    return model, names, test


@query()
def coefficients(spark, sf):
    model, names, _ = _fitted(spark, sf)
    table_ = interpret.coefficient_table(list(model.stages[-1].coefficients), names)
    return interpret.top_coefficients(table_, 10)


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + "SELECT count(*) AS n, TRUE AS additive FROM s WHERE split = 'test'"
)
def contributions_add_up(spark, sf):
    """Summed contributions rebuild the decision value of a fitted model on every test row."""
    model, _, test = _fitted(spark, sf)
    last = model.stages[-1]
    rows = interpret.contributions(model.transform(test), list(last.coefficients), last.intercept)
    check = interpret.additivity_check(rows, vector_to_array("rawPrediction")[1])
    return check.select("n", (F.col("max_difference") < 1e-8).alias("additive"))


@query()
def error_analysis(spark, sf):
    """Wrongly predicted test documents with their features, least probable first."""
    model, _, test = _fitted(spark, sf)
    scored = scoring.score(model, test)
    typed = scored.withColumn("error_type", outcome_type("label", "predicted"))
    return interpret.misclassified(rounded(typed, 6, "score", "probability_1"))


# ------------------------------------------------------------------ scoring
@query(
    f"SELECT doc_id, n_chars BETWEEN 1 AND 20000 AND n_words >= 1 AND lang IN ('de', 'en', 'es', 'fr') "
    f"AS accepted FROM ({DOCS_SQL})"
)
def score_contract(spark, sf):
    """Which rows meet the declared ranges and categories of a scoring request."""
    valid, rejected = scoring.check_contract(
        feats.RatioFeatures(DOC_SPEC.ratios).transform(labelled_docs(spark, sf)), DOC_SPEC
    )
    accept = lambda df, flag: df.select("doc_id", F.lit(flag).alias("accepted"))
    return accept(valid, True).unionByName(accept(rejected, False))


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + "SELECT count(*) AS n, 0::BIGINT AS changed FROM s WHERE split = 'test'"
)
def saved_model_scores(spark, sf):
    """A saved and reloaded model predicts the same as the one in memory."""
    model, _, test = _fitted(spark, sf)
    path = scratch_path(spark, "model")
    save_artifact(model, {"model_name": "logistic_regression", "target_mapping": {"1": 1, "0": 0}}, path)
    loaded, _ = load_artifact(spark, path)
    a = scoring.score(model, test).select("doc_id", "predicted", "score")
    b = scoring.score(loaded, test).select("doc_id", F.col("predicted").alias("q"), F.col("score").alias("t"))
    changed = (F.col("predicted") != F.col("q")) | (F.abs(F.col("score") - F.col("t")) > 1e-12)
    return a.join(b, "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(changed, 1)).alias("changed")
    )


@query()
def single_requests(spark, sf):
    """Request rows built from the median document of each language, scored like a form entry."""
    model, _, _ = _fitted(spark, sf)
    cols = ["n_chars", "n_words", "n_lines", "n_digits"]
    stats = order_stats(_docs(spark, sf), cols, [0.5], ["lang"])
    middle = stats.groupBy("lang").pivot("column", cols).agg(F.first(F.col("quantiles")[0]))
    requests = [r.asDict() for r in middle.collect()]
    schema = "lang string, n_chars double, n_words double, n_lines double, n_digits double"
    valid, _ = scoring.check_contract(
        feats.RatioFeatures(DOC_SPEC.ratios).transform(to_frame(spark, requests, schema)), DOC_SPEC
    )
    return rounded(scoring.score(model, valid, DOC_SPEC.labels), 6, "score", "probability_1")


# ------------------------------------------------------------------ streaming
_TARGET = "CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END"


@query(
    f"SELECT event_id, {_MAJORITY.format(y=_TARGET, t='events')}::BIGINT AS predicted, "
    f"{_MAJORITY.format(y=_TARGET, t='events')}::DOUBLE AS score FROM events"
)
def streamed_scores(spark, sf):
    """A fitted model applied to the event stream, written to files and read back."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    label = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    model = PipelineModel([MajorityClass().fit(events.select(label.alias("label")))])
    stream = live.read_parquet_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    sink = scratch_path(spark, "scores")
    live.score_stream(
        model, stream.select("event_id", "event_type"), sink, scratch_path(spark, "log")
    ).awaitTermination()
    return spark.read.parquet(sink).select("event_id", "predicted", "score")


#: A scorecard over events and the contract that its stream is held to.
_CARD, _CARD_CONSTANT = {"value": 0.05, "user_id": -0.01}, 0.25
CARD_SPEC = TableSpec(
    columns=("event_id", "user_id", "value", "event_type"), casts={}, target="event_type", target_map={}, regular=("value", "user_id"),
    categorical=("event_type",), bounds={"value": Bound(1.0, 80.0)}, domains={"event_type": ("click", "view", "purchase")},
)


@query(
    "SELECT event_id, CASE WHEN fine THEN (margin > 0)::BIGINT END AS predicted, CASE WHEN fine THEN round(1 / (1 + exp(-margin)), 6) END AS score, "
    "CASE WHEN NOT fine THEN concat_ws('; ', CASE WHEN value < 1 THEN 'value >= 1' END, CASE WHEN value > 80 THEN 'value <= 80' END, "
    "CASE WHEN event_type NOT IN ('click', 'view', 'purchase') THEN 'event_type in [''click'', ''view'', ''purchase'']' END) END AS broken "
    "FROM (SELECT *, coalesce(value BETWEEN 1 AND 80, TRUE) AND coalesce(event_type IN ('click', 'view', 'purchase'), TRUE) AS fine, "
    f"{_CARD_CONSTANT!r}::DOUBLE + coalesce(value, 0) * {_CARD['value']!r}::DOUBLE + coalesce(user_id, 0)::DOUBLE * {_CARD['user_id']!r}::DOUBLE AS margin "
    "FROM events)"
)
def streamed_quarantine(spark, sf):
    """The event stream scored by a scorecard, rows outside the contract set aside with the rules they break."""
    model = PipelineModel([Scorecard(_CARD, _CARD_CONSTANT)])
    stream = live.read_parquet_stream(spark, f"{sf}/events.parquet", table(spark, sf, "events").schema)
    sink, aside = scratch_path(spark, "scored"), scratch_path(spark, "rejected")
    rows = stream.select("event_id", "user_id", "value", "event_type")
    live.score_checked_stream(model, rows, CARD_SPEC, sink, aside, scratch_path(spark, "log")).awaitTermination()
    scored = live.read_batches(spark, sink).select("event_id", "predicted", F.round("score", 6).alias("score"))
    rejected = live.read_batches(spark, aside).select("event_id", F.array_join("broken_rules", "; ").alias("broken"))
    return scored.unionByName(rejected, allowMissingColumns=True)


_EDGES = [5.0, 20.0, 60.0]


@query("""
WITH ref AS (SELECT (count(*) FILTER (WHERE value <= 5))::DOUBLE / count(*) AS e0,
  (count(*) FILTER (WHERE value > 5 AND value <= 20))::DOUBLE / count(*) AS e1,
  (count(*) FILTER (WHERE value > 20 AND value <= 60))::DOUBLE / count(*) AS e2,
  (count(*) FILTER (WHERE value > 60))::DOUBLE / count(*) AS e3 FROM events WHERE value IS NOT NULL),
m AS (SELECT ts, event_type, CASE WHEN event_id % 7 = 0 THEN NULL ELSE value END AS value FROM events),
w AS (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, count(*) AS n,
  (count(*) FILTER (WHERE event_type NOT IN ('click', 'view', 'purchase')))::DOUBLE / count(*) AS unseen,
  (count(*) FILTER (WHERE value IS NULL))::DOUBLE / count(*) AS nulls,
  (count(*) FILTER (WHERE value <= 5))::DOUBLE / count(value) AS b0,
  (count(*) FILTER (WHERE value > 5 AND value <= 20))::DOUBLE / count(value) AS b1,
  (count(*) FILTER (WHERE value > 20 AND value <= 60))::DOUBLE / count(value) AS b2,
  (count(*) FILTER (WHERE value > 60))::DOUBLE / count(value) AS b3 FROM m GROUP BY 1)
SELECT strftime(window_start, '%Y-%m-%d') AS day, n, round(nulls, 6) AS null_rate, round(unseen, 6) AS unseen_rate,
  round((greatest(b0, 1e-4) - greatest(e0, 1e-4)) * ln(greatest(b0, 1e-4) / greatest(e0, 1e-4))
  + (greatest(b1, 1e-4) - greatest(e1, 1e-4)) * ln(greatest(b1, 1e-4) / greatest(e1, 1e-4))
  + (greatest(b2, 1e-4) - greatest(e2, 1e-4)) * ln(greatest(b2, 1e-4) / greatest(e2, 1e-4))
  + (greatest(b3, 1e-4) - greatest(e3, 1e-4)) * ln(greatest(b3, 1e-4) / greatest(e3, 1e-4)), 6) AS psi
FROM w, ref""")
def streamed_drift(spark, sf):
    """Drift of every day of the event stream, a seventh of its values missing, against the whole table's histogram."""
    events = table(spark, sf, "events")
    place = sum((F.when(F.col("value") > e, 1).otherwise(0) for e in _EDGES), F.lit(0))
    reference = {r[0]: r[1] for r in events.groupBy(place).count().collect()}
    total = sum(reference.values())
    expected = [reference.get(i, 0) / total for i in range(len(_EDGES) + 1)]
    masked = lambda df: df.withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    stream = live.read_parquet_stream(spark, f"{sf}/events.parquet", events.schema)
    sink = scratch_path(spark, "drift")
    profile = {
        "ts": "ts", "value": "value", "category": "event_type", "known": ["click", "view", "purchase"],
        "edges": _EDGES,
    }
    live.drift_stream(masked(stream), expected, sink, scratch_path(spark, "log"), **profile).awaitTermination()
    out = live.with_open_windows(spark.read.parquet(sink), masked(events), expected, **profile)
    return rounded(out, 6, "null_rate", "unseen_rate", "psi").select(
        F.date_format("window_start", "yyyy-MM-dd").alias("day"), "n", "null_rate", "unseen_rate", "psi"
    )


# ------------------------------------------------------------------ second tier
@query()
def feature_ablation(spark, sf):
    """The same model without the power transform and without the ratios."""
    variants = {
        "all": STAGES,
        "no_power": partial(feats.feature_stages, DOC_SPEC, power=False),
        "no_ratios": partial(feats.feature_stages, DOC_SPEC, ratios=False),
    }
    train, _ = _parts(spark, sf)
    return diag.ablation(variants, LOGISTIC, _folded(train))


@query()
def cleaning_sensitivity(spark, sf):
    """The same model with and without long documents outside the box-plot fences."""
    train, _ = _parts(spark, sf)
    folded = _folded(train)
    variants = {"kept": folded, "fenced": diag.without_outliers(folded, ["n_chars", "n_words"])}
    return diag.sensitivity(variants, LOGISTIC, STAGES)


# ------------------------------------------------------------------ batched logistic fits
#: Penalties and class weights of the models that `batched_logistic` fits together.
_RIDGES, _WEIGHTS = (0.1, 10.0), ((1.0, 1.0), (1.0, 2.5))
_NEWTON_STEPS = 9


def _batched_logistic_sql() -> str:
    """The same models by plain Newton steps from zero: sums over the rows, then Cramer's rule for the three unknowns."""
    steps = ["b0 AS (SELECT g, m, c, w, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2, 0.0::DOUBLE AS b0 FROM models)"]
    for k in range(_NEWTON_STEPS):
        steps.append(f"""s{k} AS (
  SELECT g, m, c, w, b1, b2, b0, sum(v * (p - y) * x1) + c * b1 AS g1, sum(v * (p - y) * x2) + c * b2 AS g2, sum(v * (p - y)) AS g3,
    sum(v * p * (1 - p) * x1 * x1) + c AS a, sum(v * p * (1 - p) * x1 * x2) AS d, sum(v * p * (1 - p) * x1) AS e,
    sum(v * p * (1 - p) * x2 * x2) + c AS f, sum(v * p * (1 - p) * x2) AS h, sum(v * p * (1 - p)) AS i
  FROM (SELECT b{k}.*, y, x1, x2, CASE WHEN y = 1 THEN w ELSE 1 END AS v, 1 / (1 + exp(-(b1 * x1 + b2 * x2 + b0))) AS p FROM b{k} JOIN lines USING (g))
  GROUP BY g, m, c, w, b1, b2, b0
), b{k + 1} AS (
  SELECT g, m, c, w, b1 - (g1 * (f * i - h * h) - d * (g2 * i - h * g3) + e * (g2 * h - f * g3)) / det AS b1,
    b2 - (a * (g2 * i - h * g3) - g1 * (d * i - h * e) + e * (d * g3 - g2 * e)) / det AS b2,
    b0 - (a * (f * g3 - g2 * h) - d * (d * g3 - g2 * e) + g1 * (d * h - f * e)) / det AS b0
  FROM (SELECT *, a * (f * i - h * h) - d * (d * i - h * e) + e * (d * h - f * e) AS det FROM s{k})
)""")
    models = " UNION ALL ".join(
        f"SELECT {g} AS g, {i * len(_WEIGHTS) + j} AS m, {c!r}::DOUBLE AS c, {w[1]!r}::DOUBLE AS w"
        for g in (1, 2, 3) for i, c in enumerate(_RIDGES) for j, w in enumerate(_WEIGHTS)
    )
    return f"""
WITH lines AS (
  SELECT l_linenumber AS g, (l_returnflag = 'R')::INT AS y, l_quantity::DOUBLE / 50 AS x1, l_discount::DOUBLE * 10 AS x2
  FROM lineitem WHERE l_linenumber <= 3
), models AS ({models}), {", ".join(steps)}
SELECT g::INT AS part, m::INT AS model, round(b1, 6) AS quantity, round(b2, 6) AS discount, round(b0, 6) AS intercept FROM b{_NEWTON_STEPS}
"""


@query(_batched_logistic_sql())
def batched_logistic(spark, sf):
    """Twelve logistic models of returned lines, four on each of three parts of the table, in one job a Newton step."""
    lines = table(spark, sf, "lineitem").filter("l_linenumber <= 3").select(
        F.col("l_linenumber").cast("int").alias("group"), (F.col("l_returnflag") == "R").cast("double").alias("y"),
        F.array(F.col("l_quantity").cast("double") / 50, F.col("l_discount").cast("double") * 10).alias("x"),
    )
    tasks = [
        newton.Task((g, i * len(_WEIGHTS) + j), g, c, w)
        for g in (1, 2, 3) for i, c in enumerate(_RIDGES) for j, w in enumerate(_WEIGHTS)
    ]
    fitted = newton.fit_many(lines, tasks)
    rows = [
        {"part": g, "model": m, "quantity": round(f.coefficients[0], 6), "discount": round(f.coefficients[1], 6), "intercept": round(f.intercept, 6)}
        for (g, m), f in fitted.items()
    ]
    return local_frame(spark, rows, T.StructType.fromDDL("part int, model int, quantity double, discount double, intercept double"))
