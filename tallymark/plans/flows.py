"""The three whole flows: ingest and profile, train and save, load and score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from tallymark.operators.describe import describe
from tallymark.operators.models import DUMMY, Family
from tallymark.operators.paired import paired_tests
from tallymark.operators.quality import null_profile, quality_summary
from tallymark.plans import selection as sel
from tallymark.plans.scoring import cached_model, check_contract, score
from tallymark.sources.ingest import ingest, read_csv, read_table, save_artifact, write_layer
from tallymark.spec import TableSpec


@dataclass(frozen=True)
class Profile:
    table: DataFrame
    summary: DataFrame
    nulls: DataFrame
    numbers: DataFrame


def profile(spark: SparkSession, csv: str, spec: TableSpec, base: str, name: str) -> Profile:
    """A raw CSV to a typed intermediate layer, and the layer's quality, nulls and numeric summaries."""
    path = write_layer(ingest(read_csv(spark, csv, spec), spec), base, "intermediate", name)
    table = read_table(spark, path)
    numbers = [c for c in (*spec.skewed, *spec.regular) if c in table.columns]
    return Profile(table, quality_summary(table, spec.target), null_profile(table), describe(table, numbers))


@dataclass(frozen=True)
class Training:
    comparison: DataFrame
    shortlisted: list[str]
    nested: DataFrame
    selected: str
    tests: DataFrame | None
    chosen: Family
    metrics: DataFrame
    model: PipelineModel
    metadata: dict[str, Any]


def train(
    catalog: Mapping[str, Family],
    grids: Mapping[str, Mapping[str, Sequence[Any]]],
    stages,
    train: DataFrame,
    test: DataFrame,
    key: str,
    path: str,
    y: str = "label",
    target_mapping: Mapping[Any, int] | None = None,
    folds: int = 5,
    outer: int = 5,
    inner: int = 4,
    top: int = 3,
    parallelism: int = 4,
) -> Training:
    """Compare all families, nest the shortlisted ones, test the best against the others, search it once more and save it.

    The test rows are looked at once, after everything is chosen. With one shortlisted family there is nothing to test it against.
    """
    folded = sel.stratified_folds(train, y, key, folds)
    models = {"dummy_baseline": DUMMY, **catalog}
    comparison = sel.compare_models(models, stages, folded, y, parallelism=parallelism)
    listed = [r["model"] for r in sel.shortlist(comparison, top=top).collect()]
    nested = sel.nested_cv({n: catalog[n] for n in listed}, grids, stages, train, key, y, outer, inner, parallelism=parallelism)
    selected = sel.nested_summary(nested).first()["model"]
    tests = None
    if len(listed) > 1:
        tests = paired_tests(sel.compare_to_best(nested, selected), ["model"], "selected", "other")
    model, chosen, metrics = sel.finalise(
        catalog[selected], grids[selected], stages, train, test, key, y, inner, parallelism=parallelism
    )
    last = metrics.filter("part = 'test'").first().asDict()
    metadata = {
        "model_name": selected,
        "best_params": dict(chosen.params),
        "target_mapping": {str(k): v for k, v in (target_mapping or {}).items()},
        "selection_metric": sel.REFIT,
        "test_metrics": {k: v for k, v in last.items() if k != "part"},
    }
    save_artifact(model, metadata, path)
    return Training(comparison, listed, nested, selected, tests, chosen, metrics, model, metadata)


def score_requests(path: str, requests: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """Requests that meet the contract, scored by the saved model, and the rejected ones."""
    valid, rejected = check_contract(requests, spec)
    return score(cached_model(path), valid, spec.labels), rejected
