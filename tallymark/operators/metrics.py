"""Binary classification metrics. Positive class 1; an empty denominator counts as 0.0.

Everything is derived from the rows combined per distinct score, so ranking metrics need no
global sort in one task and no second look at the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import guarded, quoted
from tallymark.operators.ordering import running_totals
from tallymark.operators.quality import percent

METRICS = (
    "accuracy", "balanced_accuracy", "precision", "recall", "f1", "roc_auc", "average_precision",
)


# Written as SQL text: these expressions are built for every fold and grid point of a search.
def _cells(y: str, prediction: str, positive: int = 1) -> list[Column]:
    actual, said = f"{quoted(y)} = {positive}", f"{quoted(prediction)} = {positive}"
    return [
        F.expr(f"count_if(NOT ({actual}) AND NOT ({said})) AS tn"),
        F.expr(f"count_if(NOT ({actual}) AND {said}) AS fp"),
        F.expr(f"count_if({actual} AND NOT ({said})) AS fn"),
        F.expr(f"count_if({actual} AND {said}) AS tp"),
    ]


def _guarded_sql(num: str, den: str) -> str:
    return f"coalesce(try_divide(double({num}), double({den})), 0D)"


def confusion(
    df: DataFrame, y: str = "label", prediction: str = "prediction",
    by: Sequence[str] = (), positive: int = 1,
) -> DataFrame:
    """``by…, tn, fp, fn, tp``."""
    cells = _cells(y, prediction, positive)
    return df.groupBy(*by).agg(*cells) if by else df.agg(*cells)


def rates() -> dict[str, Column]:
    """The threshold metrics as expressions over tn, fp, fn, tp."""
    recall, true_negatives = _guarded_sql("tp", "tp + fn"), _guarded_sql("tn", "tn + fp")
    present = "int(tp + fn > 0) + int(tn + fp > 0)"
    texts = {
        "accuracy": _guarded_sql("tp + tn", "tn + fp + fn + tp"),
        "balanced_accuracy": _guarded_sql(f"{recall} + {true_negatives}", present),
        "precision": _guarded_sql("tp", "tp + fp"),
        "recall": recall,
        "f1": _guarded_sql("2 * tp", "2 * tp + fp + fn"),
        "specificity": true_negatives,
    }
    return {name: F.expr(text) for name, text in texts.items()}


def _some(names: Sequence[str], df, y, prediction, by, positive=1) -> DataFrame:
    made = rates()
    return confusion(df, y, prediction, by, positive).select(
        *by, *[made[n].alias(n) for n in names]
    )


def accuracy(df, y="label", prediction="prediction", by=()):
    return _some(["accuracy"], df, y, prediction, by)


def balanced_accuracy(df, y="label", prediction="prediction", by=()):
    return _some(["balanced_accuracy"], df, y, prediction, by)


def precision_recall_f1(df, y="label", prediction="prediction", by=(), positive=1):
    return _some(["precision", "recall", "f1"], df, y, prediction, by, positive)


def specificity(df, y="label", prediction="prediction", by=()):
    return _some(["specificity"], df, y, prediction, by)


def classification_report(
    df: DataFrame, labels: Sequence[int] = (0, 1), y: str = "label",
    prediction: str = "prediction", names: Mapping[int, str] | None = None,
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages."""
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col(y) == F.col(prediction), 1)).alias("hits"),
    ]
    for i, v in enumerate(labels):
        actual, said = F.col(y) == v, F.col(prediction) == v
        aggs += [
            F.count(F.when(actual & said, 1)).alias(f"tp{i}"),
            F.count(F.when(actual, 1)).alias(f"sup{i}"),
            F.count(F.when(said, 1)).alias(f"said{i}"),
        ]
    wide = df.agg(*aggs)
    k = float(len(labels))
    per = []
    for i, v in enumerate(labels):
        tp, support, said = (F.col(f"{p}{i}").cast("double") for p in ("tp", "sup", "said"))
        per.append(
            (guarded(tp, said), guarded(tp, support), guarded(2.0 * tp, said + support), support)
        )
    total = sum((p[3] for p in per), F.lit(0.0))

    def row(name, values, support):
        p, r, f = values
        return F.struct(
            F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
            support.cast("bigint").alias("support"),
        )

    shown = names or {}
    rows = [row(str(shown.get(v, v)), per[i][:3], per[i][3]) for i, v in enumerate(labels)]
    acc = guarded(F.col("hits").cast("double"), F.col("n").cast("double"))
    macro = [sum((p[j] for p in per), F.lit(0.0)) / k for j in range(3)]
    weighted = [guarded(sum((p[j] * p[3] for p in per), F.lit(0.0)), total) for j in range(3)]
    rows.append(row("accuracy", (acc, acc, acc), F.col("n")))
    rows.append(row("macro avg", macro, F.col("n")))
    rows.append(row("weighted avg", weighted, F.col("n")))
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def score_table(
    df: DataFrame, y: str = "label", score: str = "score", by: Sequence[str] = (),
    prediction: str | None = None,
) -> DataFrame:
    """Positives and negatives per distinct score with their running totals from the top."""
    aggs = [
        F.expr(f"count_if({quoted(y)} = 1) AS pos"),
        F.expr(f"count_if({quoted(y)} <> 1) AS neg"),
    ]
    if prediction is not None:
        aggs += _cells(y, prediction)
    cells = df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(*aggs)
    return running_totals(
        cells, "score", ["pos", "neg"], by, ascending=False, rows=df.count()
    )


def _ranking_sums() -> list[Column]:
    up, down = "double(cum_pos)", "double(cum_neg)"
    return [
        F.expr("double(sum(pos)) AS p"),
        F.expr("double(sum(neg)) AS n"),
        F.expr(f"sum(pos * (0.5D * neg - {down})) AS below"),
        F.expr(f"sum(pos * try_divide({up}, {up} + {down})) AS steps"),
    ]


def _ranking() -> dict[str, Column]:
    return {
        "roc_auc": F.expr("try_divide(below + p * n, p * n)"),
        "average_precision": F.expr(_guarded_sql("steps", "p")),
    }


def roc_auc(df, y="label", score="score", by=()):
    """Chance that a positive outranks a negative, ties half; null with one class only."""
    sums = _grouped(score_table(df, y, score, by), by, _ranking_sums())
    return sums.select(*by, _ranking()["roc_auc"].alias("roc_auc"))


def average_precision(df, y="label", score="score", by=()):
    """Sum over distinct scores of recall gained times precision reached."""
    sums = _grouped(score_table(df, y, score, by), by, _ranking_sums())
    return sums.select(*by, _ranking()["average_precision"].alias("average_precision"))


def _grouped(df: DataFrame, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def evaluate(
    df: DataFrame, y: str = "label", prediction: str = "prediction", score: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """All eight metrics of one or more groups from one grouping of the rows."""
    table = score_table(df, y, score, by, prediction)
    sums = [*_ranking_sums(), *[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")]]
    made = {**rates(), **_ranking()}
    return _grouped(table, by, sums).select(
        *by, *[made[m].alias(m) for m in (*METRICS, "specificity")]
    )


def metric_table(frames: Mapping[str, DataFrame], **columns: str) -> DataFrame:
    """Metrics of several scored frames side by side: ``metric, <one column per name>``."""
    parts = None
    for name, frame in frames.items():
        one = evaluate(frame, **columns).select(F.lit(name).alias("part"), "*")
        parts = one if parts is None else parts.unionByName(one)
    names = [*METRICS, "specificity"]
    long = parts.unpivot("part", names, "metric", "value")
    return long.groupBy("metric").pivot("part", list(frames)).agg(F.first("value"))


def threshold_sweep(
    df: DataFrame, thresholds: Sequence[float], y: str = "label", score: str = "score"
) -> DataFrame:
    """Confusion cells and rates when predicting 1 from each threshold on."""
    steps = sorted(set(float(t) for t in thresholds))
    passed = sum((F.when(F.col(score) >= t, 1).otherwise(0) for t in steps), F.lit(0))
    cells = df.groupBy(passed.alias("passed")).agg(
        F.count(F.when(F.col(y) == 1, 1)).alias("pos"),
        F.count(F.when(F.col(y) != 1, 1)).alias("neg"),
    )
    # one row per interval between thresholds is left: its size is the number of thresholds
    sums = []
    for i, t in enumerate(steps):
        above = F.col("passed") > i
        sums += [
            F.coalesce(F.sum(F.when(above, F.col("pos"))), F.lit(0)).alias(f"tp{i}"),
            F.coalesce(F.sum(F.when(above, F.col("neg"))), F.lit(0)).alias(f"fp{i}"),
        ]
    wide = cells.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n"), *sums)
    rows = F.array(
        *[
            F.struct(
                F.lit(t).alias("threshold"), F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                (F.col("p") - F.col(f"tp{i}")).alias("fn"), (F.col("n") - F.col(f"fp{i}")).alias("tn"),
            )
            for i, t in enumerate(steps)
        ]
    )
    made = rates()
    return wide.select(F.explode(rows).alias("r")).select("r.*").select(
        "threshold", "tn", "fp", "fn", "tp",
        *[made[m].alias(m) for m in ("balanced_accuracy", "precision", "recall", "f1", "specificity")],
    )


def calibration_bins(
    df: DataFrame, bins: int = 10, y: str = "label", score: str = "score"
) -> DataFrame:
    """Reliability table over equal-width probability bins: rows, mean score, observed rate."""
    b = F.least(F.floor(F.col(score) * bins).cast("bigint"), F.lit(bins - 1))
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(score).alias("mean_score"),
        F.avg(F.col(y).cast("double")).alias("observed"),
    )


def subgroup_errors(
    df: DataFrame, by: Sequence[str], y: str = "label", prediction: str = "prediction",
    cube: bool = False,
) -> DataFrame:
    """Confusion cells and error rates per subgroup, with ``cube`` also for all roll-ups."""
    grouped = df.cube(*by) if cube else df.groupBy(*by)
    marks = [F.grouping_id().alias("level")] if cube else []
    cells = grouped.agg(*marks, F.count(F.lit(1)).alias("rows"), *_cells(y, prediction))
    wrong = F.col("fp") + F.col("fn")
    return cells.select(
        *by, *(["level"] if cube else []), F.col("rows").alias("n"), "tn", "fp", "fn", "tp",
        percent(wrong, F.col("rows"), None).alias("error_pct"),
        guarded(F.col("fn").cast("double"), (F.col("fn") + F.col("tp")).cast("double")).alias("miss_rate"),
        guarded(F.col("fp").cast("double"), (F.col("fp") + F.col("tn")).cast("double")).alias("false_alarm_rate"),
    )
