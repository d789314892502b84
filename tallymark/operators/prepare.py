"""From a typed table to a leakage-safe supervised table: cleaning, splits, folds and weights."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import hash_fraction, map_values
from tallymark.operators.ordering import (
    attach,
    class_counts,
    class_table,
    few_class_counts,
    fit_cut_table,
    fit_cuts,
    numbered,
    settle,
    split_evenly,
)
from tallymark.operators.quality import percent
from tallymark.sources.ingest import apply_casts
from tallymark.spec import TableSpec


def drop_null_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop(subset=list(subset) if subset else None)


def drop_missing_target(df: DataFrame, y: str) -> DataFrame:
    return df.na.drop(subset=[y])


def drop_exact_duplicates(df: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per distinct content. A technical key left out of the comparison keeps its
    smallest value. Copies collapse before the shuffle."""
    if not exclude:
        return df.dropDuplicates()
    content = [c for c in df.columns if c not in exclude]
    if len(exclude) == 1:
        kept = df.groupBy(*content).agg(F.min(exclude[0]).alias(exclude[0]))
    else:
        kept = df.groupBy(*content).agg(F.min(F.struct(*exclude)).alias("__k"))
        kept = kept.select(*content, "__k.*")
    return kept.select(*df.columns)


def target_code(y: str, mapping: Mapping[Any, int]) -> Column:
    """The coded target; a value outside the mapping fails the job when it is reached."""
    code = map_values(y, mapping).cast("bigint")
    problem = F.concat(F.lit(f"{y}: value outside the target domain: "), F.col(y).cast("string"))
    return F.when(code.isNotNull(), code).when(
        F.col(y).isNotNull(), F.raise_error(problem).cast("bigint")
    )


def encode_target(df: DataFrame, y: str, mapping: Mapping[Any, int], out: str = "label") -> DataFrame:
    return df.withColumn(out, target_code(y, mapping))


def assert_target_domain(df: DataFrame, y: str, domain: Sequence[Any]) -> DataFrame:
    """Check now, not when the rows are used: raises on any value outside the domain."""
    bad = df.filter(F.col(y).isNotNull() & ~F.col(y).isin(list(domain))).limit(1).collect()
    if bad:
        raise ValueError(f"{y} holds the value {bad[0][y]!r} outside {list(domain)}")
    return df


def prepare_supervised(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Casts, rows with a target, distinct rows, and the coded label."""
    typed = apply_casts(df, {c: t for c, t in spec.casts.items() if c in df.columns})
    kept = drop_missing_target(typed, spec.target)
    distinct = drop_exact_duplicates(kept, [spec.key] if spec.key in df.columns else [])
    return encode_target(distinct, spec.target, spec.target_map).drop(spec.target)


def allocate(counts: Mapping[Any, int], share: float) -> dict[Any, int]:
    """Test rows per class: ceil(share * n) in all, largest remainders first, then class order."""
    total = sum(counts.values())
    wanted = math.ceil(share * total)
    quota = {c: wanted * n / total for c, n in counts.items()} if total else {}
    given = {c: math.floor(q) for c, q in quota.items()}
    order = sorted(quota, key=lambda c: (-(quota[c] - given[c]), str(c)))
    for c in order[: wanted - sum(given.values())]:
        given[c] += 1
    return given


def allocate_table(classes: DataFrame, share: float) -> DataFrame:
    """``allocate`` for a table ``c, n`` of any size: adds ``given``."""
    total = classes.agg(F.sum("n")).first()[0] or 0
    wanted = math.ceil(share * total)
    quota = F.lit(float(wanted)) * F.col("n") / F.lit(float(total or 1))
    base = classes.select("c", "n", F.floor(quota).alias("given"), (quota - F.floor(quota)).alias("__rest"))
    short = wanted - (base.agg(F.sum("given")).first()[0] or 0)
    name = F.coalesce(F.col("c").cast("string"), F.lit("None"))
    placed = numbered(base, [F.desc("__rest"), name], "__place")
    return placed.select("c", "n", (F.col("given") + (F.col("__place") <= short).cast("bigint")).alias("given"))


def stratified_split(
    df: DataFrame,
    y: str,
    key: str | Sequence[str],
    test: float = 0.2,
    seed: int = 42,
    mode: str = "exact",
    out: str = "split",
) -> DataFrame:
    """Mark rows as ``train`` or ``test`` with equal class shares.

    The test rows of a class are the ones with the lowest hash of their (unique) key. ``exact``
    gives the class its exact number; ``hash`` needs no pass over the data and holds the share
    on average.
    """
    if mode == "hash":
        return df.withColumn(out, F.when(hash_fraction(key, seed) < test, "test").otherwise("train"))
    counts = few_class_counts(df, y)
    if counts is None:
        cuts = fit_cut_table(df, y, key, seed, allocate_table(class_table(df, y), test), F.array("given"))
    else:
        ranks = {c: [n] for c, n in allocate(counts, test).items()}
        cuts = fit_cuts(df, y, key, seed, ranks, counts)
    return cuts.mark(df, out).withColumn(out, F.when(F.col(out) == 0, "test").otherwise("train"))


def split_summary(df: DataFrame, split: str, y: str, decimals: int | None = 2) -> DataFrame:
    """Rows and percentage of positives per part."""
    return df.groupBy(split).agg(
        F.count(F.lit(1)).alias("n"),
        percent(F.sum(F.col(y).cast("double")), F.count(y), decimals).alias("positive_pct"),
    )


def stratified_folds(
    df: DataFrame, y: str, key: str | Sequence[str], k: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Fold numbers 1..k: per class, k stretches of the hash order whose sizes differ by at most
    one."""
    counts = few_class_counts(df, y)
    if counts is None:
        ends = [F.expr(f"n div {k} * {i} + least(n % {k}, {i})") for i in range(1, k)]
        cuts = fit_cut_table(df, y, key, seed, class_table(df, y), F.array(*ends) if ends else F.expr("array(n)"))
    else:
        ranks = {c: split_evenly(n, k)[:-1] for c, n in counts.items()}
        cuts = fit_cuts(df, y, key, seed, ranks, counts)
    return cuts.mark(df, out).withColumn(out, (F.col(out) + 1).cast("bigint"))


def fold_rows(df: DataFrame, i: int, fold: str = "fold") -> tuple[DataFrame, DataFrame]:
    """Training and validation rows of one fold."""
    return df.filter(F.col(fold) != i), df.filter(F.col(fold) == i)


def balanced_weights(train: DataFrame, y: str) -> dict[Any, float]:
    """n / (classes * rows of the class), from training rows only."""
    counts = class_counts(train, y)
    total, k = sum(counts.values()), len(counts)
    return {c: total / (k * n) for c, n in counts.items()}


def add_weights(
    df: DataFrame, y: str, weights: Mapping[Any, float], out: str = "class_weight"
) -> DataFrame:
    return df.withColumn(out, map_values(y, weights).cast("double"))


def weigh(train: DataFrame, y: str, out: str = "class_weight") -> DataFrame:
    """Training rows with the balanced weight of their class, for classes of any number."""
    counts = few_class_counts(train, y)
    if counts is not None:
        total, k = sum(counts.values()), len(counts)
        known = {c: total / (k * n) for c, n in counts.items() if c is not None}
        weight = map_values(y, known).cast("double")
        if None in counts:
            weight = F.when(F.col(y).isNull(), F.lit(total / (k * counts[None]))).otherwise(weight)
        return train.withColumn(out, weight)
    classes = class_table(train, y)
    total, k = classes.agg(F.sum("n"), F.count(F.lit(1))).first()
    weights = classes.select(F.col("c").alias(y), (F.lit(float(total)) / (F.lit(k) * F.col("n"))).alias("__weight"))
    return attach(train, settle(weights), [y], ["__weight"]).withColumn(out, F.col("__weight")).drop("__weight")


def null_audit(df: DataFrame, vector: str, names: Sequence[str]) -> DataFrame:
    """Missing entries per slot of a feature vector."""
    values = df.select(vector_to_array(vector).alias("v"))
    bad = lambda i: F.col("v")[i].isNull() | F.isnan(F.col("v")[i])
    counts = values.agg(*[F.count(F.when(bad(i), 1)).alias(f"c{i}") for i in range(len(names))])
    cells = F.array(
        *[
            F.struct(F.lit(n).alias("feature"), F.col(f"c{i}").alias("nulls"))
            for i, n in enumerate(names)
        ]
    )
    return counts.select(F.explode(cells).alias("p")).select("p.*")
