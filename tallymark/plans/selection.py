"""Model comparison: cross-validation, grids, nested validation, learning curves, final fit.

Folds and grid points are independent Spark jobs submitted from a few driver threads. Feature
stages are fitted once per training part and shared by all models and parameters tried on it.
"""

from __future__ import annotations

import itertools
import math
import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.operators import forest, newton
from tallymark.operators.metrics import METRICS, evaluate
from tallymark.operators.models import BUILDERS, Family, cosine_basis, kernel_width, positive_score
from tallymark.operators.ordering import class_counts, fit_cuts, local_frame
from tallymark.operators.prepare import stratified_folds
from tallymark.operators.together import FeaturePipeline

REFIT = "balanced_accuracy"


def _parallel(tasks: Sequence, work, threads: int) -> list:
    """Submit independent Spark jobs from driver threads, results in order."""
    if threads <= 1 or len(tasks) <= 1:
        return [work(t) for t in tasks]
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(work), tasks))


@contextmanager
def held(*frames: DataFrame):
    """Keep frames that many jobs read; lost blocks are recomputed from their source."""
    kept = [f.persist(StorageLevel.MEMORY_AND_DISK) for f in frames]
    try:
        yield kept
    finally:
        for f in kept:
            f.unpersist()


@contextmanager
def transformed(stages: Sequence, y: str, train: DataFrame, *others: DataFrame):
    """Fit the feature stages on the training part only and hold the vectors of all parts."""
    with held(train):
        features = FeaturePipeline(stages=list(stages)).fit(train)
        parts = [features.transform(f).select(y, "features") for f in (train, *others)]
        with held(*parts) as kept:
            yield features, kept


def combinations(grid: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All parameter combinations, the last name varying fastest."""
    names = list(grid)
    return [dict(zip(names, values)) for values in itertools.product(*grid.values())]


def fit_and_score(
    families: Mapping[str, Family], train: DataFrame, parts: Mapping[str, DataFrame], y: str, counts: Mapping
) -> tuple[dict[tuple[str, str], dict[str, float]], dict[str, float]]:
    """Fit every family, measure each fit, and evaluate all models on all named parts in one go.

    Returns the metrics by (model, part) and the seconds by model.
    """
    seconds, scored = {}, []
    for name, family in families.items():
        start = time.perf_counter()
        model = family.fit(train, y, counts)
        seconds[name] = time.perf_counter() - start
        for part, frame in parts.items():
            scored.append(
                positive_score(model.transform(frame)).select(
                    F.lit(name).alias("model"), F.lit(part).alias("part"), y,
                    F.col("prediction").cast("double").alias("prediction"), F.col("score").cast("double").alias("score"),
                )
            )
    table = evaluate(reduce(DataFrame.unionAll, scored), y, by=["model", "part"])
    metrics = {}
    for r in table.collect():
        row = r.asDict()
        metrics[row.pop("model"), row.pop("part")] = row
    return metrics, seconds


def cross_validate(
    models: Mapping[str, Family],
    stages,
    df: DataFrame,
    y: str = "label",
    fold: str = "fold",
    train_scores: bool = False,
    parallelism: int = 4,
) -> list[dict[str, Any]]:
    """Metrics of every model on every fold: rows with model, fold, part, fit_time and metrics.

    ``stages`` is a function that returns fresh feature stages. Several models are fitted together (`fit_batch`) if Newton steps can fit one.
    """
    if len(models) > 1 and _batched(models):
        rows = _batched_folds(models, stages, df, y, fold, train_scores, parallelism)
        if rows is not None:
            return rows
    with held(df) as (kept,):
        folds = sorted(r[0] for r in kept.select(fold).distinct().collect())

        def work(i):
            inside, outside = kept.filter(F.col(fold) != i), kept.filter(F.col(fold) == i)
            rows = []
            with transformed(stages(), y, inside, outside) as (_, (train, valid)):
                counts = class_counts(train, y)
                parts = {"test": valid, **({"train": train} if train_scores else {})}
                metrics, seconds = fit_and_score(models, train, parts, y, counts)
                rows += [
                    {"model": name, "fold": i, "part": p, "fit_time": seconds[name], **metrics[name, p]}
                    for name in models for p in parts if (name, p) in metrics
                ]
            return rows

        return [r for rows in _parallel(folds, work, parallelism) for r in rows]


#: Families that are fitted by the shared steps of `newton`.
STEPPED = ("logistic_regression", "svc")


def _batched(models: Mapping[str, Family]) -> bool:
    return len(models) > 0 and any(m.name in STEPPED for m in models.values())


def _task(name: tuple[int, str], family: Family, counts: Mapping[float, int]) -> newton.Task:
    n = sum(counts.values())
    balanced = family.params.get("weight") == "balanced"
    weights = (n / (2 * counts[0.0]), n / (2 * counts[1.0])) if balanced else (1.0, 1.0)
    return newton.Task(name, name[0], 1.0 / family.params.get("C", 1.0), weights, family.name == "svc")


def _stepped(models: Mapping[str, Family], vectors: DataFrame, counts: Mapping, parts: Sequence[str]) -> tuple[list[DataFrame], dict]:
    """Scored rows, and seconds by (group, model), of the logistic models and margins; those on the same vectors share their steps."""
    kernel = lambda m: (m.params.get("rff"), m.params.get("gamma", "scale")) if m.name == "svc" and m.params.get("rff") else None
    train, scored, seconds = vectors.filter("part = 'train'"), [], {}
    views = {kernel(m): None for m in models.values() if m.name in STEPPED}
    spread = {}
    if any(views):
        entries = train.select("group", F.size("x").alias("d"), F.explode("x").alias("v"))
        spread = {r[0]: (r[1], r[2]) for r in entries.groupBy("group").agg(F.max("d"), F.var_pop("v")).collect()}
    for view in views:
        mine = {name: m for name, m in models.items() if m.name in STEPPED and kernel(m) == view}
        seen = lambda df: df.select("group", "y", "x")
        if view:
            size, gamma = view
            bases = {g: cosine_basis(d, size, kernel_width({"gamma": gamma}, d, v)) for g, (d, v) in spread.items()}
            seen = partial(newton.cosine_rows, bases=bases)
        tasks = [_task((g, name), m, counts[g]) for g in counts for name, m in mine.items()]
        start = time.perf_counter()
        fitted = newton.fit_many(seen(train), tasks)
        each = (time.perf_counter() - start) / len(tasks)
        seconds |= {t.name: each for t in tasks}
        names = F.array(*[F.struct(F.lit(t.name[0]).alias("group"), F.lit(t.name[1]).alias("model")) for t in tasks])
        for part in parts:
            rows = newton.score_many(seen(vectors.filter(F.col("part") == part)), tasks, fitted)
            scored.append(rows.select(names[F.col("task")].alias("t"), "y", "prediction", "score").select("t.*", F.lit(part).alias("part"), "y", "prediction", "score"))
    return scored, seconds


def _grown(models: Mapping[str, Family], vectors: DataFrame, counts: Mapping, parts: Sequence[str]) -> tuple[list[DataFrame], dict]:
    """Scored rows, and seconds by (group, model), of majority classes, and of trees and forests if one task can hold all rows."""
    scored, seconds = [], {}
    for name, m in models.items():
        if m.name == "dummy_baseline":
            best = {g: min(c, key=lambda v: (-c[v], v)) for g, c in counts.items()}  # noqa: B023
            said = F.create_map(*[F.lit(v) for pair in best.items() for v in pair])[F.col("group")]
            scored.append(vectors.select("group", F.lit(name).alias("model"), "part", "y", said.alias("prediction"), said.alias("score")))
            seconds |= {(g, name): 0.0 for g in counts}
    if vectors.count() > forest.WHOLE_ROWS:
        return scored, seconds
    kinds: dict[tuple, dict[str, Family]] = {}
    for name, m in models.items():
        if m.name in ("decision_tree", "random_forest"):
            kinds.setdefault((m.params.get("weight"), m.params.get("bins", 64)), {})[name] = m
    for mine in kinds.values():
        start = time.perf_counter()
        forests = {name: BUILDERS[m.name](m.params, "y", 0, None, None) for name, m in mine.items()}
        weights = {g: _task((g, ""), next(iter(mine.values())), c).weights for g, c in counts.items()}
        scored.append(forest.grow_and_score(vectors, list(counts), parts, forests, weights))
        each = (time.perf_counter() - start) / (len(counts) * len(mine))
        seconds |= {(g, name): each for g in counts for name in mine}
    return scored, seconds


def fit_batch(
    models: Mapping[str, Family], groups: Mapping[int, Mapping[str, DataFrame]], y: str, parallelism: int = 4
) -> dict[tuple[int, str, str], dict[str, Any]] | None:
    """Metrics by (group, model, part) of models, each fitted on the "train" part of every group.

    ``groups`` holds frames of ``y`` and ``features`` under the numbers from 0. All logistic models and margins of all groups share their
    jobs (one a Newton step), so do trees and forests if one task can hold all rows, and one evaluation looks at all models; the other
    families are fitted group by group. None if some group has not both classes;
    the models then need fits of their own. The fit time of a model that shares its jobs is its share.
    """
    few = sum(f.rdd.getNumPartitions() for f in next(iter(groups.values())).values()) <= 16
    vectors = reduce(DataFrame.unionAll, [
        newton.grouped_rows({g: f}, y).withColumn("part", F.lit(p)) for g, parts in groups.items() for p, f in parts.items()
    ])
    with held(vectors.coalesce(2 * vectors.sparkSession.sparkContext.defaultParallelism) if few else vectors) as (vectors,):
        counts: dict[int, dict[float, int]] = {g: {} for g in groups}
        for r in vectors.filter("part = 'train'").groupBy("group", "y").count().collect():
            counts[r["group"]][r["y"]] = r["count"]
        if any(set(c) != {0.0, 1.0} for c in counts.values()):
            return None
        parts = sorted({p for f in groups.values() for p in f})
        scored, seconds = _stepped(models, vectors, counts, parts)

        def work(task):
            g, name = task
            rows = vectors.filter(F.col("group") == g).select("part", "y", array_to_vector("x").alias("features"))
            start = time.perf_counter()
            model = models[name].fit(rows.filter("part = 'train'").drop("part"), "y", counts[g])
            seconds[task] = time.perf_counter() - start
            return positive_score(model.transform(rows)).select(
                F.lit(g).alias("group"), F.lit(name).alias("model"), "part", "y",
                F.col("prediction").cast("double").alias("prediction"), F.col("score").cast("double").alias("score"),
            )

        more, shared = _grown(models, vectors, counts, parts)
        scored, seconds = scored + more, seconds | shared
        scored += _parallel([(g, name) for name in models if (0, name) not in seconds for g in groups], work, parallelism)
        with held(reduce(DataFrame.unionAll, scored)) as (scored,):
            table = evaluate(scored, "y", by=["group", "model", "part"]).collect()
    out = {}
    for r in table:
        row = r.asDict()
        g, name, part = (row.pop(c) for c in ("group", "model", "part"))
        out[g, name, part] = {"fit_time": seconds[g, name], "rows": sum(counts[g].values()), **row}
    return out


def _batched_folds(models, stages, df, y, fold, train_scores, parallelism) -> list[dict[str, Any]] | None:
    """``cross_validate`` by `fit_batch`: features are fitted fold by fold, the models of all folds together."""
    with held(df) as (kept,):
        folds = sorted(r[0] for r in kept.select(fold).distinct().collect())

        def work(i):
            inside, outside = kept.filter(F.col(fold) != i), kept.filter(F.col(fold) == i)
            features = FeaturePipeline(stages=list(stages())).fit(inside)
            return {p: features.transform(f).select(y, "features") for p, f in (("train", inside), ("test", outside))}

        groups = dict(enumerate(_parallel(folds, work, parallelism)))
        found = fit_batch(models, groups, y, parallelism)
    if found is None:
        return None
    parts = ("test", "train") if train_scores else ("test",)
    return [
        {"model": name, "fold": i, "part": p, **{k: v for k, v in found[g, name, p].items() if k != "rows"}}
        for g, i in enumerate(folds) for name in models for p in parts if (g, name, p) in found
    ]


SCORE_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("fold", T.LongType()),
        T.StructField("part", T.StringType()),
        T.StructField("fit_time", T.DoubleType()),
        *[T.StructField(m, T.DoubleType()) for m in (*METRICS, "specificity")],
    ]
)


def score_frame(rows: Sequence[Mapping[str, Any]]) -> DataFrame:
    """Per-fold results as a frame (one row per model, fold and part)."""
    return local_frame(
        SparkSession.active(), [{n: r.get(n) for n in SCORE_SCHEMA.names} for r in rows], SCORE_SCHEMA
    )


def summarise_folds(scores: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Mean and population deviation per model, best balanced accuracy, recall, F1 first."""
    test = scores.filter(F.col("part") == "test")
    means = [F.avg(m).alias(f"{m}_mean") for m in metrics]
    spreads = [F.stddev_pop(m).alias(f"{m}_std") for m in metrics]
    return (
        test.groupBy("model")
        .agg(*means, *spreads, F.avg("fit_time").alias("fit_time_mean"))
        .orderBy(*[F.desc(f"{m}_mean") for m in ("balanced_accuracy", "recall", "f1")], "model")
    )


def compare_models(
    models: Mapping[str, Family], stages, df: DataFrame, y: str = "label", **options
) -> DataFrame:
    return summarise_folds(score_frame(cross_validate(models, stages, df, y, **options)))


def shortlist(
    comparison: DataFrame, by: str = "balanced_accuracy_mean", top: int = 3,
    baseline: str = "dummy_baseline",
) -> DataFrame:
    """Real models at or above the mean of the real models, at most ``top``, best first."""
    real = comparison.filter(F.col("model") != baseline)
    mean = real.agg(F.avg(by)).scalar()
    order = [by, *[c for c in ("recall_mean", "f1_mean") if c in comparison.columns]]
    return real.filter(F.col(by) >= mean).orderBy(*[F.desc(c) for c in order], "model").limit(top)


def fold_fit_times(scores: DataFrame) -> DataFrame:
    """Seconds spent fitting, per model and fold."""
    return scores.filter(F.col("part") == "test").select("model", "fold", "fit_time")


def _mean(values: Sequence[float | None]) -> float | None:
    """The mean over the folds in which the metric is defined."""
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def search(
    catalog: Mapping[str, Family],
    grids: Mapping[str, Mapping[str, Sequence[Any]]],
    stages,
    df: DataFrame,
    y: str = "label",
    fold: str = "fold",
    refit: str = REFIT,
    parallelism: int = 4,
) -> tuple[dict[str, Family], dict[str, list[dict[str, Any]]]]:
    """Try every combination of every family on every fold.

    Returns per family the parameters with the best mean (the first one on ties) and the results.
    """
    tried = {name: combinations(grids[name]) for name in catalog}
    models = {
        f"{name}:{i}": catalog[name].with_params(**p)
        for name, listed in tried.items()
        for i, p in enumerate(listed)
    }
    rows = cross_validate(models, stages, df, y, fold, parallelism=parallelism)
    chosen, results = {}, {}
    for name, listed in tried.items():
        results[name] = []
        for i, params in enumerate(listed):
            mine = [r for r in rows if r["model"] == f"{name}:{i}"]
            means = {m: _mean([r[m] for r in mine]) for m in (*METRICS, "specificity")}
            results[name].append({"combination": i, "params": params, **means})
        # where the metric is undefined in every fold, the first combination stays
        best = max(
            results[name], key=lambda r: (-math.inf if r[refit] is None else r[refit], -r["combination"])
        )
        chosen[name] = models[f"{name}:{best['combination']}"]
    return chosen, results


def fit_all(
    families: Mapping[str, Family], stages, df: DataFrame, y: str = "label"
) -> dict[str, PipelineModel]:
    """Each family fitted on all given rows behind the same fitted features."""
    out = {}
    with transformed(stages(), y, df) as (features, (train,)):
        counts = class_counts(train, y)
        for name, family in families.items():
            model = family.fit(train, y, counts)
            tail = model.stages if isinstance(model, PipelineModel) else [model]
            out[name] = PipelineModel([*features.stages, *tail])
    return out


def fit_final(family: Family, stages, df: DataFrame, y: str = "label") -> PipelineModel:
    """Features and model fitted on all given rows, as one pipeline."""
    return fit_all({"final": family}, stages, df, y)["final"]


def grid_search(
    family: Family,
    grid: Mapping[str, Sequence[Any]],
    stages,
    df: DataFrame,
    y: str = "label",
    fold: str = "fold",
    refit: str = REFIT,
    parallelism: int = 4,
) -> tuple[PipelineModel, Family, list[dict[str, Any]]]:
    """Search one family, then refit the best combination on all rows."""
    chosen, results = search({"one": family}, {"one": grid}, stages, df, y, fold, refit, parallelism)
    return fit_final(chosen["one"], stages, df, y), chosen["one"], results["one"]


def nested_cv(
    catalog: Mapping[str, Family],
    grids: Mapping[str, Mapping[str, Sequence[Any]]],
    stages,
    df: DataFrame,
    key: str,
    y: str = "label",
    outer: int = 5,
    inner: int = 4,
    seed: int = 42,
    parallelism: int = 4,
) -> DataFrame:
    """Search on inner folds of each outer training part; score on its outer validation part."""
    with held(stratified_folds(df, y, key, outer, seed, "outer_fold")) as (tagged,):

        def work(i):
            inside = tagged.filter(F.col("outer_fold") != i)
            inside = stratified_folds(inside, y, key, inner, seed, "fold")
            outside = tagged.filter(F.col("outer_fold") == i)
            threads = max(1, parallelism // outer)
            chosen, _ = search(catalog, grids, stages, inside, y, parallelism=threads)
            return [
                {
                    "model": name, "fold": i, "part": "test", "fit_time": None,
                    **evaluate(positive_score(model.transform(outside)), y).first().asDict(),
                }
                for name, model in fit_all(chosen, stages, inside, y).items()
            ]

        rows = _parallel(range(1, outer + 1), work, parallelism)
    return score_frame([r for part in rows for r in part])


NESTED_METRICS = ("balanced_accuracy", "recall", "f1", "roc_auc")


def nested_summary(scores: DataFrame) -> DataFrame:
    """Mean and sample deviation of the four nested metrics, best first."""
    return (
        scores.groupBy("model")
        .agg(
            *[F.avg(m).alias(f"{m}_mean") for m in NESTED_METRICS],
            *[F.stddev_samp(m).alias(f"{m}_std") for m in NESTED_METRICS],
        )
        .orderBy(F.desc("balanced_accuracy_mean"), "model")
    )


def compare_to_best(scores: DataFrame, best: str, metric: str = REFIT) -> DataFrame:
    """Fold scores of every other model beside the ones of the selected model, for paired tests."""
    mine = scores.filter(F.col("model") == best).select("fold", F.col(metric).alias("selected"))
    others = scores.filter(F.col("model") != best).select("model", "fold", F.col(metric).alias("other"))
    return others.join(mine, "fold")


def learning_curve(
    family: Family,
    stages,
    df: DataFrame,
    key: str,
    y: str = "label",
    fold: str = "fold",
    fractions: Sequence[float] = (0.2, 0.4, 0.6, 0.8, 1.0),
    seed: int = 42,
    metric: str = REFIT,
    parallelism: int = 4,
) -> DataFrame:
    """Train and validation score against growing nested parts of each fold's training rows.

    ``fraction, train_size, train_score_mean, validation_score_mean, fit_time_mean``.
    """
    with held(df) as (kept,):
        folds = sorted(r[0] for r in kept.select(fold).distinct().collect())

        def order(i):
            inside = kept.filter(F.col(fold) != i)
            counts = class_counts(inside, y)
            ranks = {c: [max(1, round(f * n)) for f in fractions] for c, n in counts.items()}
            cuts = fit_cuts(inside, y, key, seed, ranks, counts)
            return cuts.mark(inside, "__step")

        ordered = {i: order(i) for i in folds}

        def work(task):
            i, step = task
            part = ordered[i].filter(F.col("__step") <= step)
            outside = kept.filter(F.col(fold) == i)
            with transformed(stages(), y, part, outside) as (_, (train, valid)):
                counts = class_counts(train, y)
                parts = {"train": train, "test": valid}
                m, seconds = fit_and_score({"model": family}, train, parts, y, counts)
            scores = (m["model", "train"][metric], m["model", "test"][metric])
            return step, sum(counts.values()), *scores, seconds["model"]

        tasks = [(i, step) for i in folds for step in range(len(fractions))]
        rows = None
        if family.name == "logistic_regression":

            def parts_of(task):
                i, step = task
                part, outside = ordered[i].filter(F.col("__step") <= step), kept.filter(F.col(fold) == i)
                features = FeaturePipeline(stages=list(stages())).fit(part)
                return {p: features.transform(f).select(y, "features") for p, f in (("train", part), ("test", outside))}

            found = fit_batch({"model": family}, dict(enumerate(_parallel(tasks, parts_of, parallelism))), y)
            if found is not None:
                rows = [
                    (step, found[g, "model", "train"]["rows"], found[g, "model", "train"][metric], found[g, "model", "test"][metric], found[g, "model", "test"]["fit_time"])
                    for g, (_, step) in enumerate(tasks)
                ]
        if rows is None:
            rows = _parallel(tasks, work, parallelism)
    out = []
    for step, fraction in enumerate(fractions):
        mine = [r for r in rows if r[0] == step]
        mean = lambda j: _mean([r[j] for r in mine])  # noqa: B023, E731
        out.append(
            {
                "fraction": float(fraction), "train_size": mean(1), "train_score_mean": mean(2),
                "validation_score_mean": mean(3), "fit_time_mean": mean(4),
            }
        )
    schema = T.StructType.fromDDL(
        "fraction double, train_size double, train_score_mean double, "
        "validation_score_mean double, fit_time_mean double"
    )
    return local_frame(SparkSession.active(), out, schema)


def finalise(
    family: Family,
    grid: Mapping[str, Sequence[Any]],
    stages,
    train: DataFrame,
    test: DataFrame,
    key: str,
    y: str = "label",
    inner: int = 4,
    seed: int = 42,
    parallelism: int = 4,
) -> tuple[PipelineModel, Family, DataFrame]:
    """Last search on all training rows, then the only look at the test rows.

    Returns the model, the chosen parameters and ``part, <metrics>`` for train and test.
    """
    folded = stratified_folds(train, y, key, inner, seed)
    model, chosen, _ = grid_search(family, grid, stages, folded, y, parallelism=parallelism)
    parts = None
    for name, frame in (("train", train), ("test", test)):
        one = evaluate(positive_score(model.transform(frame)), y).select(
            F.lit(name).alias("part"), "*"
        )
        parts = one if parts is None else parts.unionByName(one)
    return model, chosen, parts
