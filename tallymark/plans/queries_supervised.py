"""Queries over cleaning, splits, folds, fitted features and metrics."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tallymark.functions.columns import yeo_johnson
from tallymark.operators import association as assoc
from tallymark.operators import features as feats
from tallymark.operators import metrics as met
from tallymark.operators import prepare as prep
from tallymark.operators.calibration import platt
from tallymark.operators.together import FeaturePipeline
from tallymark.plans.diagnostics import calibrate, oversample, quantile_rule
from tallymark.plans.frames import (
    DOC_SPEC,
    DOCS_SQL,
    EVENT_SPEC,
    ORDERS_SQL,
    TYPED_SQL,
    folds_sql,
    labelled_docs,
    landed_docs,
    landed_events,
    messy_events,
    order_sql,
    scored_orders,
    split_sql,
)
from tallymark.plans.queries_profile import rounded, stacked
from tallymark.plans.registry import query, table
from tallymark.sources.ingest import ingest

# ------------------------------------------------------------------ cleaning
@query(
    "SELECT user_id, event_type, k, CASE code WHEN 1 THEN 1::BIGINT WHEN 2 THEN 0::BIGINT END AS label, "
    f"min(event_id) AS event_id FROM ({TYPED_SQL}) WHERE code IS NOT NULL GROUP BY ALL"
)
def supervised_events(spark, sf):
    typed = ingest(messy_events(spark, sf), EVENT_SPEC).select(
        "event_id", "user_id", "event_type", "k", "code"
    )
    return prep.prepare_supervised(typed, EVENT_SPEC)


@query("SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def distinct_rows(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag")
    return prep.drop_exact_duplicates(rows)


@query(
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1::BIGINT WHEN 'O' THEN 2::BIGINT "
    "WHEN 'P' THEN 0::BIGINT END AS label FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')"
)
def coded_target(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    checked = prep.assert_target_domain(orders, "o_orderstatus", ["F", "O", "P"])
    return prep.encode_target(checked, "o_orderstatus", {"F": 1, "O": 2, "P": 0}).drop("o_orderstatus")


# ------------------------------------------------------------------ split, folds, weights
_ORDER_LABELS = "SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label FROM orders"


@query(split_sql(_ORDER_LABELS, "label", "o_orderkey") + "SELECT o_orderkey, label, split FROM s")
def stratified_split(spark, sf):
    orders = scored_orders(spark, sf).select("o_orderkey", "label")
    return prep.stratified_split(orders, "label", "o_orderkey")


_DATED = "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders"


def _dated_orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day"))


@query(split_sql(_DATED, "day", "o_orderkey") + "SELECT o_orderkey, day, split FROM s")
def many_class_split(spark, sf):
    """Orders split with equal shares of every day, more classes than literals may hold."""
    return prep.stratified_split(_dated_orders(spark, sf), "day", "o_orderkey")


@query(folds_sql(_DATED, "day", "o_orderkey", 3))
def many_class_folds(spark, sf):
    return prep.stratified_folds(_dated_orders(spark, sf), "day", "o_orderkey", 3)


@query(
    "SELECT o_orderkey, day, round(sum(1) OVER ()::DOUBLE / ((SELECT count(DISTINCT day) FROM "
    f"({_DATED})) * count(*) OVER (PARTITION BY day)), 8) AS class_weight FROM ({_DATED})"
)
def many_class_weights(spark, sf):
    return rounded(prep.weigh(_dated_orders(spark, sf), "day"), 8, "class_weight")


@query(
    "SELECT o_orderkey, CASE WHEN ('0x' || substr(" + order_sql("o_orderkey") + ", 1, 12))::BIGINT::DOUBLE "
    "/ 281474976710656.0::DOUBLE < 0.2::DOUBLE THEN 'test' ELSE 'train' END AS split FROM orders"
)
def hashed_split(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return prep.stratified_split(orders, "", "o_orderkey", mode="hash")


@query(
    split_sql(_ORDER_LABELS, "label", "o_orderkey")
    + "SELECT split, count(*) AS n, round(100.0::DOUBLE * avg(label), 4) AS positive_pct FROM s GROUP BY split"
)
def split_summary(spark, sf):
    return prep.split_summary(stratified_split(spark, sf), "split", "label", decimals=4)


@query(f"SELECT o_orderkey, label, fold FROM ({folds_sql(_ORDER_LABELS, 'label', 'o_orderkey')})")
def stratified_folds(spark, sf):
    orders = scored_orders(spark, sf).select("o_orderkey", "label")
    return prep.stratified_folds(orders, "label", "o_orderkey")


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + ", t AS (SELECT quality, count(*) AS n FROM s WHERE split = 'train' GROUP BY 1) "
    "SELECT doc_id, quality, round((SELECT sum(n) FROM t)::DOUBLE / (2 * t.n), 8) AS class_weight "
    "FROM s JOIN t USING (quality) WHERE split = 'train'"
)
def class_weights(spark, sf):
    train = _train(spark, sf).select("doc_id", "quality")
    weighted = prep.add_weights(train, "quality", prep.balanced_weights(train, "quality"))
    return rounded(weighted, 8, "class_weight")


def _split_docs(spark, sf):
    return prep.stratified_split(landed_docs(spark, sf), "quality", "doc_id")


def _train(spark, sf):
    return _split_docs(spark, sf).filter("split = 'train'")


def _labelled(df):
    return df.withColumnRenamed("quality", "label")


# ------------------------------------------------------------------ fitted features
_NUM = ["n_chars", "n_words", "n_lines", "n_digits"]


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + "SELECT * FROM ("
    + stacked(
        "SELECT '{c}' AS \"column\", round(abs(corr({c}, quality)), 6) AS abs_r FROM s WHERE split = 'train'",
        _NUM,
    )
    + ")"
)
def train_association(spark, sf):
    return assoc.rank_association(_train(spark, sf), _NUM, "quality", 6)


_VALUE_SPLIT = split_sql(
    f"SELECT * FROM ({TYPED_SQL}) WHERE code IS NOT NULL", "code", "event_id"
)


def _split_events(spark, sf):
    typed = landed_events(spark, sf)
    return prep.stratified_split(prep.drop_missing_target(typed, "code"), "code", "event_id")


@query(
    _VALUE_SPLIT
    + ", m AS (SELECT quantile_cont(value, 0.5) AS mv, quantile_cont(k::DOUBLE, 0.5) AS mk, "
    "mode() WITHIN GROUP (ORDER BY event_type) AS mt FROM s WHERE split = 'train') "
    "SELECT event_id, split, coalesce(value, mv) AS value, coalesce(k::DOUBLE, mk) AS k, "
    "coalesce(event_type, mt) AS event_type FROM s, m"
)
def imputed_events(spark, sf):
    rows = _split_events(spark, sf).select("event_id", "split", "value", "k", "event_type")
    train = rows.filter("split = 'train'")
    pipe = FeaturePipeline(stages=[feats.MedianImputer(["value", "k"]), feats.ModeImputer(["event_type"])])
    return pipe.fit(train).transform(rows)


@query(
    _VALUE_SPLIT
    + ", m AS (SELECT quantile_cont(value, 0.5) AS mv, quantile_cont(value, 0.75) - "
    "quantile_cont(value, 0.25) AS iv, quantile_cont(k::DOUBLE, 0.5) AS mk, quantile_cont(k::DOUBLE, 0.75) "
    "- quantile_cont(k::DOUBLE, 0.25) AS ik FROM s WHERE split = 'train') "
    "SELECT event_id, split, round((value - mv) / iv, 6) AS value, round((k - mk) / ik, 6) AS k FROM s, m"
)
def robust_scaled_events(spark, sf):
    rows = _split_events(spark, sf).select("event_id", "split", "value", "k")
    model = feats.RobustScale(["value", "k"]).fit(rows.filter("split = 'train'"))
    return rounded(model.transform(rows), 6, "value", "k")


@query(
    f"SELECT doc_id, round(n_chars::DOUBLE / nullif(n_words, 0), 6) AS chars_per_word, "
    f"round(n_digits::DOUBLE / nullif(n_lines - 1, 0), 6) AS digits_per_line FROM ({DOCS_SQL})"
)
def ratio_features(spark, sf):
    docs = labelled_docs(spark, sf).withColumn("breaks", F.col("n_lines") - 1)
    stage = feats.RatioFeatures(
        [("chars_per_word", "n_chars", "n_words"), ("digits_per_line", "n_digits", "breaks")]
    )
    made = stage.transform(docs).select("doc_id", "chars_per_word", "digits_per_line")
    return rounded(made, 6, "chars_per_word", "digits_per_line")


_KINDS = ["click", "purchase", "view"]


@query(
    f"SELECT event_id, "
    + ", ".join(
        f"CASE WHEN event_type = '{v}' THEN 1.0::DOUBLE ELSE 0.0 END AS hot_{v}" for v in _KINDS
    )
    + f" FROM ({TYPED_SQL})"
)
def one_hot_events(spark, sf):
    """Learned without sign-ups, applied to all rows: an unseen or missing type is all zeros."""
    rows = ingest(messy_events(spark, sf), EVENT_SPEC).select("event_id", "event_type")
    train = rows.filter("event_type <> 'signup'")
    model = FeaturePipeline(stages=feats.one_hot(["event_type"])).fit(train)
    hot = vector_to_array("event_type__hot")
    return model.transform(rows).select(
        "event_id", *[hot[i].alias(f"hot_{v}") for i, v in enumerate(_KINDS)]
    )


@query(
    "SELECT l_orderkey, l_linenumber, l_extendedprice, "
    "round(((l_extendedprice + 1) ** 0.3::DOUBLE - 1) / 0.3::DOUBLE, 4) AS upper, "
    "round(ln(l_extendedprice + 1), 6) AS logged, "
    "round(-((-(l_discount - 0.2::DOUBLE) + 1) ** 1.7::DOUBLE - 1) / 1.7::DOUBLE, 6) AS lower, "
    "round(-ln(-(l_discount - 0.2::DOUBLE) + 1), 6) AS lower_logged FROM lineitem"
)
def power_transformed(spark, sf):
    lines = table(spark, sf, "lineitem").withColumn("shifted", F.col("l_discount") - F.lit(0.2))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.round(yeo_johnson("l_extendedprice", 0.3), 4).alias("upper"),
        F.round(yeo_johnson("l_extendedprice", 0.0), 6).alias("logged"),
        F.round(yeo_johnson("shifted", 0.3), 6).alias("lower"),
        F.round(yeo_johnson("shifted", 2.0), 6).alias("lower_logged"),
    )


_LAMBDAS = [-1.0, -0.5, 0.25, 0.5, 1.0]


@query(
    " UNION ALL ".join(
        f"SELECT {lam}::DOUBLE AS lambda, round(-count(value) / 2.0::DOUBLE * ln(var_pop(((value + 1) ** "
        f"({lam}::DOUBLE) - 1) / ({lam}::DOUBLE))) + ({lam}::DOUBLE - 1) * sum(ln(value + 1)), 3) AS "
        "likelihood FROM events"
        for lam in _LAMBDAS
    )
)
def power_likelihood(spark, sf):
    """The likelihood that the power transform maximises, at given lambdas."""
    from tallymark.operators.ordering import local_frame
    from pyspark.sql import types as T

    made = feats.lambda_likelihoods(table(spark, sf, "events"), {"value": _LAMBDAS})["value"]
    rows = [{"lambda": lam, "likelihood": v} for lam, v in zip(_LAMBDAS, made)]
    schema = T.StructType.fromDDL("lambda double, likelihood double")
    return rounded(local_frame(spark, rows, schema), 3, "likelihood")


@query()
def fitted_power_lambdas(spark, sf):
    from pyspark.ml import PipelineModel

    events = table(spark, sf, "events").select("value")
    return feats.fitted_parameters(PipelineModel([feats.YeoJohnson(["value"]).fit(events)]))


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + ", z AS (SELECT *, n_chars::DOUBLE / nullif(n_words, 0) AS chars_per_word, "
    "n_words::DOUBLE / nullif(n_lines, 0) AS words_per_line FROM s WHERE split = 'train') "
    + stacked(
        "SELECT '{c}' AS feature, round(quantile_cont({c}::DOUBLE, 0.5), 6) AS median FROM z",
        [*DOC_SPEC.skewed, *DOC_SPEC.regular],
    )
)
def learned_medians(spark, sf):
    """The report of learned parameters, restricted to the medians."""
    spec = DOC_SPEC
    stages = [
        feats.RatioFeatures(spec.ratios),
        feats.MedianImputer([*spec.skewed, *spec.regular]),
    ]
    fitted = feats.fitted_parameters(FeaturePipeline(stages=stages).fit(_train(spark, sf)))
    return fitted.select("feature", F.round(F.col("value").cast("double"), 6).alias("median"))


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + ", z AS (SELECT doc_id, split, lang, n_lines, n_digits FROM s), "
    "m AS (SELECT quantile_cont(n_lines::DOUBLE, 0.5) AS ml, quantile_cont(n_lines::DOUBLE, 0.75) - "
    "quantile_cont(n_lines::DOUBLE, 0.25) AS il, quantile_cont(n_digits::DOUBLE, 0.5) AS md, "
    "quantile_cont(n_digits::DOUBLE, 0.75) - quantile_cont(n_digits::DOUBLE, 0.25) AS id "
    "FROM z WHERE split = 'train') "
    "SELECT doc_id, split, round((n_lines - ml) / CASE WHEN il = 0 THEN 1 ELSE il END, 6) AS n_lines, "
    "round((n_digits - md) / CASE WHEN id = 0 THEN 1 ELSE id END, 6) AS n_digits, "
    + ", ".join(
        f"CASE WHEN lang = '{v}' THEN 1.0::DOUBLE ELSE 0.0 END AS lang_{v}" for v in ("de", "en", "es", "fr")
    )
    + " FROM z, m"
)
def routed_features(spark, sf):
    """Numeric and categorical roles through the assembled pipeline, read back by slot name."""
    rows = _split_docs(spark, sf).select("doc_id", "split", "lang", "n_lines", "n_digits")
    pipe = FeaturePipeline(stages=feats.route([], ["n_lines", "n_digits"], ["lang"]))
    train = rows.filter("split = 'train'")
    model = pipe.fit(train)
    vector = vector_to_array("features")
    named = [
        F.round(vector[i], 6).alias(n) if n.startswith("n_") else vector[i].alias(n)
        for i, n in enumerate(feats.feature_names(model))
    ]
    return model.transform(rows).select("doc_id", "split", *named)


@query()
def transformed_documents(spark, sf):
    """All feature stages learned on training rows and applied to both parts."""
    rows = _labelled(_split_docs(spark, sf))
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    a, b, names = feats.fit_transform(feats.build_feature_pipeline(DOC_SPEC), train, test)
    vector = vector_to_array("features")
    both = a.unionByName(b)
    return both.select(
        "doc_id", "split", *[F.round(vector[i], 6).alias(n) for i, n in enumerate(names)]
    )


@query(
    f"SELECT feature, CAST(0 AS BIGINT) AS nulls FROM (SELECT unnest(['chars_per_word', 'lang_de', "
    "'lang_en', 'lang_es', 'lang_fr', 'n_chars', 'n_digits', 'n_lines', 'n_words', 'words_per_line']) "
    "AS feature) WHERE (SELECT count(*) FROM labels) > 0"
)
def transformed_null_audit(spark, sf):
    docs = _labelled(landed_docs(spark, sf))
    model = feats.build_feature_pipeline(DOC_SPEC).fit(docs)
    return prep.null_audit(model.transform(docs), "features", feats.feature_names(model))


@query(
    f"SELECT doc_id, round(ln(n_chars + 1), 6) AS logged, round(sqrt(n_words), 6) AS rooted, "
    f"(n_lines * n_lines)::DOUBLE AS squared, (n_digits * n_lines)::DOUBLE AS product FROM ({DOCS_SQL})"
)
def extra_features(spark, sf):
    docs = labelled_docs(spark, sf)
    crossed = feats.interaction(["n_digits", "n_lines"], "crossed").transform(
        docs.withColumns({c: F.col(c).cast("double") for c in ("n_digits", "n_lines")})
    )
    return crossed.select(
        "doc_id",
        F.round(feats.log1p_column("n_chars"), 6).alias("logged"),
        F.round(feats.sqrt_column("n_words"), 6).alias("rooted"),
        feats.square_column("n_lines").alias("squared"),
        vector_to_array("crossed")[0].alias("product"),
    )


# ------------------------------------------------------------------ metrics
_CELLS = (
    "count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
    "count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
    "count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, "
    "count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp"
)
_Z = "CASE WHEN {d} = 0 THEN 0.0::DOUBLE ELSE ({n})::DOUBLE / ({d}) END"


def ratio_sql(n: str, d: str) -> str:
    return _Z.format(n=n, d=d)


RATES = {
    "accuracy": ratio_sql("tp + tn", "(tp + tn + fp + fn)"),
    "balanced_accuracy": f"(({ratio_sql('tp', '(tp + fn)')}) + ({ratio_sql('tn', '(tn + fp)')})) / 2",
    "precision": ratio_sql("tp", "(tp + fp)"),
    "recall": ratio_sql("tp", "(tp + fn)"),
    "f1": ratio_sql("2 * tp", "(2 * tp + fp + fn)"),
    "specificity": ratio_sql("tn", "(tn + fp)"),
}


def rates_sql(digits: int = 6, names=tuple(RATES)) -> str:
    return ", ".join(f"round({RATES[n]}, {digits}) AS {n}" for n in names)


@query(f"SELECT o_orderpriority, {_CELLS} FROM ({ORDERS_SQL}) GROUP BY o_orderpriority")
def confusion_by_priority(spark, sf):
    return met.confusion(scored_orders(spark, sf), by=["o_orderpriority"])


@query(
    f"SELECT {rates_sql()} FROM (SELECT {_CELLS} FROM ({ORDERS_SQL}))"
)
def threshold_metrics(spark, sf):
    """Accuracy, balanced accuracy, precision, recall, F1 and specificity from one count."""
    cells = met.confusion(scored_orders(spark, sf))
    made = met.rates()
    return cells.select(*[F.round(made[n], 6).alias(n) for n in RATES])


def _report_sql() -> str:
    rows = []
    for v, tp, sup, said in (("0", "tn", "(tn + fp)", "(tn + fn)"), ("1", "tp", "(tp + fn)", "(tp + fp)")):
        rows.append((v, ratio_sql(tp, said), ratio_sql(tp, sup), ratio_sql(f"2 * {tp}", f"({sup} + {said})"), sup))
    n = "(tn + fp + fn + tp)"
    acc = ratio_sql("tp + tn", n)
    parts = list(rows)
    parts.append(("accuracy", acc, acc, acc, n))
    parts.append(("macro avg", *[f"(({rows[0][j]}) + ({rows[1][j]})) / 2" for j in (1, 2, 3)], n))
    parts.append(
        ("weighted avg",
         *[f"(({rows[0][j]}) * {rows[0][4]} + ({rows[1][j]}) * {rows[1][4]}) / {n}" for j in (1, 2, 3)], n)
    )
    return " UNION ALL ".join(
        f"SELECT '{v}' AS class, round({p}, 6) AS precision, round({r}, 6) AS recall, round({f}, 6) AS f1, "
        f"{s} AS support FROM z"
        for v, p, r, f, s in parts
    )


@query(f"WITH z AS (SELECT {_CELLS} FROM ({ORDERS_SQL})) {_report_sql()}")
def classification_report(spark, sf):
    return rounded(met.classification_report(scored_orders(spark, sf)), 6, "precision", "recall", "f1")


def ranking_sql(source: str, by: str = "") -> str:
    """ROC-AUC and average precision from the table of distinct scores."""
    group = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    return (
        f"SELECT {group}(sum(pos * (0.5::DOUBLE * neg - cn)) + sum(pos)::DOUBLE * sum(neg)) / "
        "nullif(sum(pos)::DOUBLE * sum(neg), 0) AS roc_auc, "
        "CASE WHEN sum(pos) = 0 THEN 0.0::DOUBLE ELSE sum(pos * (cp::DOUBLE / (cp + cn))) / sum(pos) END "
        f"AS average_precision FROM (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC)::DOUBLE AS cp, "
        f"sum(neg) OVER ({part}ORDER BY score DESC)::DOUBLE AS cn FROM (SELECT {group}score, "
        "(count(*) FILTER (WHERE label = 1))::DOUBLE AS pos, (count(*) FILTER (WHERE label = 0))::DOUBLE AS neg "
        f"FROM ({source}) GROUP BY {group}score)){f' GROUP BY {by}' if by else ''}"
    )


@query(f"SELECT round(roc_auc, 8) AS roc_auc FROM ({ranking_sql(ORDERS_SQL)})")
def roc_auc(spark, sf):
    return rounded(met.roc_auc(scored_orders(spark, sf)), 8, "roc_auc")


@query(
    f"SELECT round(average_precision, 8) AS average_precision FROM ({ranking_sql(ORDERS_SQL)})"
)
def average_precision(spark, sf):
    return rounded(met.average_precision(scored_orders(spark, sf)), 8, "average_precision")


@query(
    f"SELECT a.o_orderpriority, {rates_sql()}, round(roc_auc, 6) AS roc_auc, "
    "round(average_precision, 6) AS average_precision "
    f"FROM (SELECT o_orderpriority, {_CELLS} FROM ({ORDERS_SQL}) GROUP BY 1) a JOIN "
    f"({ranking_sql(ORDERS_SQL, 'o_orderpriority')}) b ON a.o_orderpriority = b.o_orderpriority"
)
def metrics_by_priority(spark, sf):
    made = met.evaluate(scored_orders(spark, sf), by=["o_orderpriority"])
    return rounded(made, 6, *met.METRICS, "specificity")


_SPLIT_ORDERS = split_sql(ORDERS_SQL, "label", "o_orderkey")


@query(
    _SPLIT_ORDERS
    + ", e AS ("
    + " UNION ALL ".join(
        f"SELECT '{p}' AS part, {rates_sql()}, (SELECT round(roc_auc, 6) FROM "
        f"({ranking_sql(f'SELECT * FROM s WHERE split = {chr(39)}{p}{chr(39)}')})) AS roc_auc, "
        f"(SELECT round(average_precision, 6) FROM "
        f"({ranking_sql(f'SELECT * FROM s WHERE split = {chr(39)}{p}{chr(39)}')})) AS average_precision "
        f"FROM (SELECT {_CELLS} FROM s WHERE split = '{p}')"
        for p in ("train", "test")
    )
    + ") SELECT metric, max(CASE WHEN part = 'train' THEN value END) AS train, "
    "max(CASE WHEN part = 'test' THEN value END) AS test FROM (UNPIVOT e ON "
    + ", ".join([*RATES, "roc_auc", "average_precision"])
    + " INTO NAME metric VALUE value) GROUP BY metric"
)
def train_test_metrics(spark, sf):
    rows = prep.stratified_split(scored_orders(spark, sf), "label", "o_orderkey")
    out = met.metric_table(
        {"train": rows.filter("split = 'train'"), "test": rows.filter("split = 'test'")}
    )
    return rounded(out, 6, "train", "test")


_STEPS = [50.0, 100.0, 200.0, 300.0, 400.0]


@query(
    f"SELECT threshold, tn, fp, fn, tp, "
    + rates_sql(6, ("balanced_accuracy", "precision", "recall", "f1", "specificity"))
    + f" FROM (SELECT t AS threshold, {_CELLS.replace('prediction', '(score >= t)::INT')} FROM "
    f"({ORDERS_SQL}), (SELECT unnest([{', '.join(f'{s}::DOUBLE' for s in _STEPS)}]) AS t) GROUP BY t)"
)
def threshold_sweep(spark, sf):
    out = met.threshold_sweep(scored_orders(spark, sf), _STEPS)
    return rounded(out, 6, "balanced_accuracy", "precision", "recall", "f1", "specificity")


@query(
    f"SELECT least(CAST(floor(score / 1000 * 10) AS BIGINT), 9) AS bin, count(*) AS n, "
    f"round(avg(score / 1000), 6) AS mean_score, round(avg(label), 6) AS observed FROM ({ORDERS_SQL}) GROUP BY 1"
)
def calibration_bins(spark, sf):
    scored = scored_orders(spark, sf).withColumn("score", F.col("score") / 1000)
    return rounded(met.calibration_bins(scored), 6, "mean_score", "observed")


@query(
    _SPLIT_ORDERS
    + """, p AS (SELECT score AS x, count(*)::DOUBLE AS w, sum(label)::DOUBLE AS s, row_number() OVER (ORDER BY score) AS i
  FROM s WHERE split = 'train' GROUP BY score),
cum AS (SELECT *, sum(w) OVER (ORDER BY i) AS cw, sum(s) OVER (ORDER BY i) AS cs FROM p),
lowest AS (SELECT a.i AS a, b.i AS k, min((b.cs - a.cs + a.s) / (b.cw - a.cw + a.w)) OVER (PARTITION BY a.i ORDER BY b.i DESC) AS m
  FROM cum a JOIN cum b ON b.i >= a.i),
v AS (SELECT i, x, max(m) AS v FROM lowest JOIN p ON k = i GROUP BY i, x),
pairs AS (SELECT x, v, lead(x) OVER (ORDER BY i) AS x2, lead(v) OVER (ORDER BY i) AS v2 FROM v),
ends AS (SELECT min(x) AS x, min(v) AS v, max(v) AS top FROM v)
SELECT o_orderkey, label, score, round(CASE WHEN score < ends.x THEN ends.v WHEN x2 IS NULL THEN top
  ELSE pairs.v + (v2 - pairs.v) * (score - pairs.x) / (x2 - pairs.x) END, 6) AS calibrated
FROM s CROSS JOIN ends LEFT JOIN pairs ON score >= pairs.x AND (x2 IS NULL OR score < x2) WHERE split = 'test'"""
)
def calibrated_scores(spark, sf):
    """A monotone score-to-probability map learned on training orders, applied to test orders."""
    rows = prep.stratified_split(scored_orders(spark, sf), "label", "o_orderkey")
    model = calibrate(rows.filter("split = 'train'"))
    out = model.transform(rows.filter("split = 'test'"))
    return out.select("o_orderkey", "label", "score", F.round("calibrated", 6).alias("calibrated"))


#: Plain Newton steps of the SQL beside `platt_scores`.
_CURVE_STEPS = 8


def _platt_sql() -> str:
    steps = ["b0 AS (SELECT 0.0::DOUBLE AS a, 0.0::DOUBLE AS b)"]
    for k in range(_CURVE_STEPS):
        steps.append(f"""h{k} AS (SELECT a, b, sum((n * p - t) * z) AS g1, sum(n * p - t) AS g0, sum(n * p * (1 - p) * z * z) AS h11,
  sum(n * p * (1 - p) * z) AS h10, sum(n * p * (1 - p)) AS h00
  FROM (SELECT *, 1 / (1 + exp(-(a * z + b))) AS p FROM cells, b{k}) GROUP BY a, b),
b{k + 1} AS (SELECT a - (h00 * g1 - h10 * g0) / (h11 * h00 - h10 * h10) AS a, b - (h11 * g0 - h10 * g1) / (h11 * h00 - h10 * h10) AS b FROM h{k})""")
    return f"""{_SPLIT_ORDERS}, t AS (SELECT score, label FROM s WHERE split = 'train'),
m AS (SELECT avg(score) AS centre, stddev_pop(score) AS spread, sum(label)::DOUBLE AS n1, (count(*) - sum(label))::DOUBLE AS n0 FROM t),
cells AS (SELECT (score - centre) / spread AS z, count(*)::DOUBLE AS n,
  sum(CASE WHEN label = 1 THEN (n1 + 1) / (n1 + 2) ELSE 1 / (n0 + 2) END) AS t FROM t, m GROUP BY score, centre, spread),
{", ".join(steps)}
SELECT o_orderkey, label, score, round(1 / (1 + exp(-(a * (score - centre) / spread + b))), 6) AS calibrated
FROM s, m, b{_CURVE_STEPS} WHERE split = 'test'"""


@query(_platt_sql())
def platt_scores(spark, sf):
    """A logistic curve over the score learned on training orders, applied to test orders."""
    rows = prep.stratified_split(scored_orders(spark, sf), "label", "o_orderkey")
    out = platt(rows.filter("split = 'train'")).transform(rows.filter("split = 'test'"))
    return out.select("o_orderkey", "label", "score", F.round("calibrated", 6).alias("calibrated"))


@query(
    "SELECT *, round(100 * (fp + fn)::DOUBLE / n, 6) AS error_pct, round(fn::DOUBLE / nullif(fn + tp, 0), 6) AS miss_rate, "
    "round(fp::DOUBLE / nullif(fp + tn, 0), 6) AS false_alarm_rate FROM ("
    f"SELECT o_orderpriority, round_price, CAST(grouping(o_orderpriority, round_price) AS BIGINT) AS level, "
    f"count(*) AS n, {_CELLS} FROM (SELECT *, floor(o_totalprice / 100000)::BIGINT AS round_price "
    f"FROM ({ORDERS_SQL})) GROUP BY CUBE (o_orderpriority, round_price))"
)
def subgroup_errors(spark, sf):
    rows = scored_orders(spark, sf).withColumn(
        "round_price", F.floor(F.col("o_totalprice") / 100000).cast("bigint")
    )
    out = met.subgroup_errors(rows, ["o_orderpriority", "round_price"], cube=True)
    return out.select("o_orderpriority", "round_price", F.col("level").cast("bigint").alias("level"),
                      "n", "tn", "fp", "fn", "tp", *[F.round(c, 6).alias(c) for c in ("error_pct", "miss_rate", "false_alarm_rate")])


@query(
    split_sql(DOCS_SQL, "quality", "doc_id")
    + ", lim AS (SELECT quantile_cont(n_chars::DOUBLE, 0.9) AS hi, quantile_cont(n_words::DOUBLE, 0.1) AS lo "
    "FROM s WHERE split = 'train'), p AS (SELECT quality AS label, CASE WHEN n_chars > hi OR n_words < lo "
    f"THEN 1 ELSE 0 END AS prediction FROM s, lim WHERE split = 'test') SELECT {rates_sql()} FROM (SELECT {_CELLS} FROM p)"
)
def heuristic_baseline(spark, sf):
    rows = _labelled(_split_docs(spark, sf))
    apply = quantile_rule(
        rows.filter("split = 'train'"), [("n_chars", "above", 0.9), ("n_words", "below", 0.1)]
    )
    cells = met.confusion(apply(rows.filter("split = 'test'")))
    made = met.rates()
    return cells.select(*[F.round(made[n], 6).alias(n) for n in RATES])


@query(
    f"WITH d AS ({DOCS_SQL}), c AS (SELECT quality, count(*) AS n, max(count(*)) OVER () AS top FROM d GROUP BY 1), "
    f"r AS (SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {order_sql('doc_id')}) AS rn FROM d) "
    "SELECT doc_id, quality, unnest(range(1, top // n + CASE WHEN rn <= top % n THEN 1 ELSE 0 END + 1)) AS copy "
    "FROM r JOIN c USING (quality)"
)
def oversampled(spark, sf):
    docs = landed_docs(spark, sf).select("doc_id", "quality")
    return oversample(docs, "quality", "doc_id")
