"""Many logistic models or linear margins at once: one Spark job makes a Newton step for all of them.

Each row belongs to a group (a fold, a step of a curve), and each model is fitted on the rows of one group. The rows are packed once into
matrices of one group each. A pass over these adds up every model's loss, gradient and second derivatives as matrix products; a task
reports once per model, the reports are added up, and the driver solves one small system a model. So the number of jobs is that of the
steps, whatever the number of models, and rows of different groups may come in any order. Groups that one task can hold are fitted by one
task each, all steps in one job.
"""

from __future__ import annotations

from collections.abc import Hashable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STEPS = 60
#: A model is done once a step changes its loss by less than this share.
ENOUGH = 1e-12
#: Of a margin: the passes, and the share of its loss that a whole step may promise at the end, for the last of its rounded hinges and others.
MARGIN_STEPS, MARGIN_ENOUGH, ROUGHLY = 200, 1e-6, 1e-4
#: A hinge is rounded over this distance to both sides of its corner at first, and over a quarter of it in each further round, until
#: rounding adds no more than this share to the loss.
ROUNDED, SHARP = 16.0, 2e-5
#: So many halvings of a margin's step are looked at together with the whole step.
HALVINGS = 7


@dataclass(frozen=True)
class Task:
    """One model: the group whose rows it learns from, its ridge penalty (half of it times the squared weights is added to the summed
    loss) and the weight of either class. Its loss is the logistic one, or the hinge of a margin."""

    name: Hashable
    group: int
    penalty: float
    weights: tuple[float, float] = (1.0, 1.0)
    margin: bool = False


@dataclass
class Fitted:
    coefficients: np.ndarray
    intercept: float
    loss: float
    steps: int


def grouped_rows(frames: Mapping[int, DataFrame], y: str, features: str = "features") -> DataFrame:
    """(group, y, x): the labelled vectors of all groups as arrays."""
    out = None
    for group, df in frames.items():
        one = df.select(F.lit(int(group)).alias("group"), F.col(y).cast("double").alias("y"), vector_to_array(features).alias("x"))
        out = one if out is None else out.unionAll(one)
    return out


def cosine_rows(rows: DataFrame, bases: Mapping[int, tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(group, y, x) with each vector turned into the cosine features of its group's directions and offsets."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, y, x in _blocks(them):
            directions, offsets = bases[group]
            z = np.sqrt(2.0 / len(offsets)) * np.cos(x[:, :-1] @ directions + offsets)
            lists = pa.ListArray.from_arrays(np.arange(0, z.size + 1, len(offsets), dtype=np.int32), z.ravel())
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), group, np.int32)), pa.array(y), lists], names=["group", "y", "x"])

    return rows.select("group", "y", "x").mapInArrow(batches, "group int, y double, x array<double>")


def _blocks(them: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, labels, vectors with a last column of ones) of the rows of each group in each batch, in their order."""
    for batch in them:
        groups, labels = np.asarray(batch.column("group")), np.asarray(batch.column("y"))
        lists = batch.column("x")
        offsets, values = np.asarray(lists.offsets), np.asarray(lists.values)
        order = np.argsort(groups, kind="stable")
        cuts = np.flatnonzero(np.append(True, np.diff(groups[order]) != 0)) if len(groups) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(groups)]):
            mine = order[lo:hi]
            width = int(offsets[mine[0] + 1] - offsets[mine[0]])
            x = np.ones((hi - lo, width + 1))
            x[:, :width] = values[offsets[mine][:, None] + np.arange(width)]
            yield int(groups[mine[0]]), labels[mine], x


#: A packed matrix has about so many bytes at most, and a task holds a few times as many.
PACKED = 4 << 20
_PACKED_SCHEMA = "group int, width int, y binary, x binary"


def _packed(rows: DataFrame) -> DataFrame:
    """The rows as matrices of one group each (`_PACKED_SCHEMA`), the vectors with a last column of ones."""

    def pack(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for group, parts in waiting.items():
                y, x = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
                step = max(1, PACKED // x[0].nbytes)
                for at in range(0, len(y), step):
                    columns = [
                        pa.array([group], pa.int32()), pa.array([x.shape[1]], pa.int32()),
                        pa.array([y[at : at + step].tobytes()], pa.binary()), pa.array([x[at : at + step].tobytes()], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["group", "width", "y", "x"])
            waiting.clear()

        for group, y, x in _blocks(them):
            waiting.setdefault(group, []).append((y, x))
            held += x.nbytes + y.nbytes
            if held >= 4 * PACKED:
                yield from flush()
                held = 0
        yield from flush()

    return rows.mapInArrow(pack, _PACKED_SCHEMA)


def _matrices(them: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(group, labels, vectors with a last column of ones) of each packed matrix."""
    for batch in them:
        for group, width, y, x in zip(*(batch.column(n) for n in ("group", "width", "y", "x"))):
            yield group.as_py(), np.frombuffer(y.as_buffer()), np.frombuffer(x.as_buffer()).reshape(-1, width.as_py())


def _logistic(margin: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """(Loss, the same, slopes, bends) of logistic models."""
    yes, small = y > 0.5, np.exp(-np.abs(margin))
    p = np.where(margin >= 0, 1.0, small) / (1 + small)
    loss = (weight * (np.maximum(np.where(yes, -margin, margin), 0) + np.log1p(small))).sum()
    return loss, loss, weight * (p - y), weight * p * (1 - p)


def _hinge(margin: np.ndarray, y: np.ndarray, weight: np.ndarray, rounded: float):
    """(Loss of the rounded hinge, of the hinge itself, slopes, bends) of margins."""
    side = np.where(y > 0.5, 1.0, -1.0)
    short = 1 - side * margin
    part = np.clip((short + rounded) / (2 * rounded), 0, 1)
    exact = np.maximum(short, 0)
    loss = np.where(np.abs(short) < rounded, rounded * part * part, exact)
    return (weight * loss).sum(), (weight * exact).sum(), -side * weight * part, np.where(np.abs(short) < rounded, weight / (2 * rounded), 0.0)


def _total(x: np.ndarray, y: np.ndarray, task: Task, point: np.ndarray, rounded: float, base: np.ndarray, upper) -> np.ndarray:
    """What rows add to the sums of a task (`_sums`)."""
    out = np.zeros(2 + HALVINGS + len(point) + len(upper[0]))
    for lo in range(0, len(y), 1 << 14):  # what a stretch needs stays in the processor's cache
        some, labels = x[lo : lo + (1 << 14)], y[lo : lo + (1 << 14)]
        weight = np.where(labels > 0.5, task.weights[1], task.weights[0])
        margin = some @ point
        loss, exact, slope, bend = _hinge(margin, labels, weight, rounded) if task.margin else _logistic(margin, labels, weight)
        way, bent = np.zeros(HALVINGS), some
        if task.margin:
            near = bend > 0  # most rows are straight
            bent, bend = some[near], bend[near]
            if (base != point).any():
                start = some @ base
                way = [_hinge(start + (margin - start) * 0.5 ** (j + 1), labels, weight, rounded)[0] for j in range(HALVINGS)]
        out += np.concatenate([[loss, exact], way, some.T @ slope, ((bent * bend[:, None]).T @ bent)[upper]])
    return out


def _sums(
    rows: DataFrame, tasks: Sequence[Task], points: np.ndarray, open_tasks: Sequence[int], rounded: np.ndarray, bases: np.ndarray, parts: int
) -> dict[int, np.ndarray]:
    """Loss (of margins with a rounded hinge), loss itself, losses on the way from the base to the point (of margins, at a half, a
    quarter ...), gradient and upper triangle of second derivatives of each open task at its point, over packed rows."""
    width = points.shape[1]
    upper = np.triu_indices(width)
    by_group: dict[int, list[int]] = {}
    for k in open_tasks:
        by_group.setdefault(tasks[k].group, []).append(k)

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for group, y, x in _matrices(them):
            for k in by_group.get(group, []):
                total = _total(x, y, tasks[k], points[k], rounded[k], bases[k], upper)
                totals[k] = totals[k] + total if k in totals else total
        for k, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["task", "v"])

    def add(part: pa.Table) -> pa.Table:
        total = np.sum(np.sort(np.stack([np.frombuffer(v.as_py()) for v in part.column("v")]), axis=0), axis=0)
        return pa.table({"task": pa.array([part.column("task")[0].as_py()], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})

    schema = "task int, v binary"
    sums = rows.mapInArrow(batches, schema)
    if parts > FEW_PARTS:
        sums = sums.groupBy("task").applyInArrow(add, schema)
    out: dict[int, list[np.ndarray]] = {k: [] for k in open_tasks}
    for r in sums.collect():
        out[r["task"]].append(np.frombuffer(bytes(r["v"])))
    # in an order of their own, so that the result doesn't hang on who reports first
    return {k: np.sum(np.sort(np.stack(v), axis=0), axis=0) if v else np.zeros(2 + HALVINGS + width + len(upper[0])) for k, v in out.items()}


#: Up to so many partitions the driver adds up the reports of all tasks, above that Spark does.
FEW_PARTS = 64


def fit_many(rows: DataFrame, tasks: Sequence[Task], steps: int = STEPS) -> dict[Hashable, Fitted]:
    """The models of all tasks from `rows` (`grouped_rows`), by damped Newton steps; the intercept carries no penalty.

    A job evaluates every open model at its next point. A step that makes the loss larger is halved, a model whose loss no longer falls
    is done. Rows are read once and held as packed matrices, which each step goes over.
    """
    packed = _packed(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _newton(packed, tasks, steps)
    finally:
        packed.unpersist()


#: Groups whose vectors have up to so many bytes are each fitted by one task, all steps in one job.
WHOLE_BYTES = 32 << 20


def _newton(rows: DataFrame, tasks: Sequence[Task], steps: int) -> dict[Hashable, Fitted]:
    """`fit_many` over packed rows."""
    sizes = rows.select("group", "width", F.length("x").alias("n"), F.spark_partition_id().alias("p"))
    found = sizes.groupBy("group").agg(F.max("width"), F.sum("n"), F.max("p")).collect()
    if not found:
        raise ValueError("no rows to fit on")
    width = max(r[1] for r in found)
    if max(r[2] for r in found) <= WHOLE_BYTES:
        return _whole(rows, tasks, width, steps)
    return _solve(width, tasks, steps, lambda *at: _sums(rows, tasks, *at, max(r[3] for r in found) + 1))


def _whole(rows: DataFrame, tasks: Sequence[Task], width: int, steps: int) -> dict[Hashable, Fitted]:
    """The models of each group by one task that has the group's rows."""
    places: dict[int, list[int]] = {}
    for k, t in enumerate(tasks):
        places.setdefault(t.group, []).append(k)
    upper = np.triu_indices(width)

    def fit(part: pa.Table) -> pa.Table:
        blocks = sorted(_matrices(part.to_batches()), key=lambda b: (len(b[1]), b[1].tobytes(), b[2][0].tobytes()))
        y, x = np.concatenate([b[1] for b in blocks]), np.concatenate([b[2] for b in blocks])
        mine = places.get(blocks[0][0], [])
        few = [tasks[k] for k in mine]
        sums = lambda points, some, rounded, bases: {k: _total(x, y, few[k], points[k], rounded[k], bases[k], upper) for k in some}
        fitted = _solve(width, few, steps, sums)
        told = [[*fitted[t.name].coefficients, fitted[t.name].intercept, fitted[t.name].loss, fitted[t.name].steps] for t in few]
        return pa.table({"task": pa.array(mine, pa.int32()), "v": pa.array(told, pa.list_(pa.float64()))})

    found = {r["task"]: np.array(r["v"]) for r in rows.groupBy("group").applyInArrow(fit, "task int, v array<double>").collect()}
    if len(found) < len(tasks):  # a group without rows keeps its starting point
        found |= {k: np.zeros(width + 2) for k in range(len(tasks)) if k not in found}
    return {t.name: Fitted(found[k][: width - 1], float(found[k][width - 1]), float(found[k][width]), int(found[k][width + 1])) for k, t in enumerate(tasks)}


def _solve(width: int, tasks: Sequence[Task], steps: int, sums) -> dict[Hashable, Fitted]:
    """The models, given a function that tells the sums of open tasks at their points (`_sums`)."""
    points, ridge = np.zeros((len(tasks), width)), np.ones(width)
    ridge[-1] = 0
    upper = np.triu_indices(width)
    best: list[tuple[float, np.ndarray] | None] = [None] * len(tasks)
    steps_of, size, taken = [np.zeros(width) for _ in tasks], np.ones(len(tasks)), np.zeros(len(tasks), int)
    bases = points.copy()
    rounded, sharp, spent = np.full(len(tasks), ROUNDED), np.zeros(len(tasks), bool), np.zeros(len(tasks), int)
    open_tasks = list(range(len(tasks)))
    while open_tasks:
        left = []
        for k, total in sums(points, open_tasks, rounded, bases).items():
            spent[k] += 1
            if spent[k] > (max(steps, MARGIN_STEPS) if tasks[k].margin else steps):
                continue
            penalty, before = tasks[k].penalty, best[k]
            burden = lambda at: 0.5 * penalty * float((ridge * at**2).sum())  # noqa: B023, E731
            loss = total[0] + burden(points[k])
            if before is not None and not loss <= before[0] + ENOUGH * max(abs(before[0]), 1.0):
                shares = 0.5 ** np.arange(1, HALVINGS + 1)
                if tasks[k].margin:  # the best of the halvings
                    on_way = [total[2 + j] + burden(before[1] + s * size[k] * steps_of[k]) for j, s in enumerate(shares)]
                    size[k] *= shares[int(np.argmin(on_way))]
                else:
                    size[k] /= 2
                if size[k] > (1e-30 if tasks[k].margin else 1e-6):
                    points[k] = before[1] + size[k] * steps_of[k]
                    left.append(k)
                    continue
                points[k], stuck = before[1].copy(), True
            else:
                taken[k] += 1
                best[k], stuck = (loss, points[k].copy()), False
                if tasks[k].margin:
                    sharp[k] = total[0] - total[1] <= SHARP * max(loss, 1e-300)
            if not tasks[k].margin and (stuck or (before is not None and before[0] - loss <= ENOUGH * max(abs(loss), 1.0))):
                continue
            if not stuck:
                slope = total[2 + HALVINGS : 2 + HALVINGS + width] + penalty * ridge * points[k]
                bend = np.zeros((width, width))
                bend[upper] = total[2 + HALVINGS + width :]
                bend = bend + np.triu(bend, 1).T + np.diag(penalty * ridge + 1e-12)
                step = -np.linalg.lstsq(bend, slope, rcond=None)[0]
            # a short step of a margin may gain little far from the end, so what a whole step promises counts
            if tasks[k].margin and (stuck or -0.5 * slope @ step <= (MARGIN_ENOUGH if sharp[k] else ROUGHLY) * max(abs(loss), 1e-300)):
                if not sharp[k] and rounded[k] > 1e-6:
                    rounded[k] /= 4
                    best[k], size[k], bases[k] = None, 1.0, points[k]  # the same point has another loss now
                    left.append(k)
                continue
            bases[k] = points[k]
            steps_of[k], size[k] = step, 1.0
            points[k] = points[k] + step
            left.append(k)
        open_tasks = left
    return {t.name: Fitted(b[1][:-1], float(b[1][-1]), b[0], int(n)) for t, b, n in zip(tasks, best, taken)}


def score_many(rows: DataFrame, tasks: Sequence[Task], models: Mapping[Hashable, Fitted]) -> DataFrame:
    """(task, y, prediction, score) of every row under each model of its group; `task` is the place in `tasks`. The score is the
    probability of class 1, or the decision value of a margin."""
    by_group: dict[int, list[int]] = {}
    for k, t in enumerate(tasks):
        by_group.setdefault(t.group, []).append(k)
    weights = [np.append(models[t.name].coefficients, models[t.name].intercept) for t in tasks]

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, y, x in _blocks(them):
            for k in by_group.get(group, []):
                value = x @ weights[k]
                score = value if tasks[k].margin else 1 / (1 + np.exp(-np.clip(value, -700, 700)))
                said = value > 0 if tasks[k].margin else score > 0.5
                columns = [pa.array(np.full(len(y), k, np.int32)), pa.array(y), pa.array(said.astype(float)), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, names=["task", "y", "prediction", "score"])

    schema = T.StructType.fromDDL("task int, y double, prediction double, score double")
    return rows.mapInArrow(batches, schema)
