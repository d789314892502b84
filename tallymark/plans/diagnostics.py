"""Second-tier studies around a trained classifier."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators.calibration import isotonic
from tallymark.operators.models import Family
from tallymark.operators.ordering import class_table, few_class_counts, fit_cut_table, fit_cuts, quantile_values
from tallymark.plans.selection import cross_validate, score_frame, summarise_folds


def calibrate(train: DataFrame, y: str = "label", score: str = "score", digits: int | None = None):
    """A monotone map from scores to probabilities, fitted on held-out training scores of any range.

    ``digits`` rounds the scores first; without it every distinct score is a point of its own.
    """
    rows = train if digits is None else train.withColumn(score, F.round(score, digits))
    return isotonic(rows, y, score)


def ablation(
    variants: Mapping[str, object], family: Family, df: DataFrame, y: str = "label", **options
) -> DataFrame:
    """The same model cross-validated with different feature stages (name -> stage factory)."""
    rows = []
    for name, stages in variants.items():
        rows += cross_validate({name: family}, stages, df, y, **options)  # one fit per variant
    return summarise_folds(score_frame(rows))


def sensitivity(
    variants: Mapping[str, DataFrame], family: Family, stages, y: str = "label", **options
) -> DataFrame:
    """The same model and stages cross-validated on differently cleaned tables."""
    rows = []
    for name, df in variants.items():
        rows += cross_validate({name: family}, stages, df, y, **options)
    return summarise_folds(score_frame(rows))


def without_outliers(df: DataFrame, cols: Sequence[str], whisker: float = 1.5) -> DataFrame:
    """Rows whose values all lie inside the box-plot fences (missing values pass)."""
    keep = F.lit(True)
    for c, (q1, q3) in quantile_values(df, cols, [0.25, 0.75]).items():
        reach = whisker * (q3 - q1)
        keep = keep & F.coalesce(F.col(c).between(q1 - reach, q3 + reach), F.lit(True))
    return df.filter(keep)


def quantile_rule(
    train: DataFrame, rules: Sequence[tuple[str, str, float]], needed: int = 1
):
    """A transparent baseline: predict 1 where at least ``needed`` markers are beyond their
    training quantile. Each rule is (column, 'above' or 'below', quantile).

    Returns a function that adds ``prediction`` and ``score`` (share of rules met).
    """
    limits = [quantile_values(train, [c], [q])[c][0] for c, _, q in rules]
    met = sum(
        (
            F.when(F.col(c) > v if side == "above" else F.col(c) < v, 1).otherwise(0)
            for (c, side, _), v in zip(rules, limits)
        ),
        F.lit(0),
    )

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "score": met.cast("double") / F.lit(float(len(rules))),
                "prediction": F.when(met >= needed, 1.0).otherwise(0.0),
            }
        )

    return apply


def oversample(train: DataFrame, y: str, key: str, seed: int = 42) -> DataFrame:
    """Repeat rows of the smaller classes until every class is as large as the largest.

    Each row is repeated evenly; the remainder goes to the rows first in hash order. Adds
    ``copy``, 1 for the original.
    """
    counts = few_class_counts(train, y)
    if counts is None:
        return _oversample_many(train, y, key, seed)
    largest = max(counts.values(), default=0)
    cuts = fit_cuts(train, y, key, seed, {c: [largest % n] for c, n in counts.items()}, counts)
    extra = F.when(F.col("__step") == 0, 1).otherwise(0)
    times = F.lit(1)
    for c, n in counts.items():
        times = F.when(F.col(y).eqNullSafe(F.lit(c)), F.lit(largest // n) + extra).otherwise(times)
    numbers = F.sequence(F.lit(1).cast("bigint"), times.cast("bigint"))
    marked = cuts.mark(train, "__step")
    return marked.select(*train.columns, F.explode(numbers).alias("copy"))


def _oversample_many(train: DataFrame, y: str, key: str, seed: int) -> DataFrame:
    """``oversample`` with the classes in a table."""
    classes = class_table(train, y)
    largest = classes.agg(F.max("n")).first()[0]
    classes = classes.select("*", F.expr(f"{largest} div n").alias("__times"), F.expr(f"{largest} % n").alias("__more"))
    marked = fit_cut_table(train, y, key, seed, classes, F.array("__more"), ["__times"]).mark(train, "__step", ["__times"])
    times = F.col("__times") + F.when(F.col("__step") == 0, 1).otherwise(0)
    return marked.select(*train.columns, F.explode(F.sequence(F.lit(1).cast("bigint"), times.cast("bigint"))).alias("copy"))
