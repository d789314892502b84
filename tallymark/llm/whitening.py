"""Embedding whitening: projections on the leading eigenvectors of the covariance, each over the root of its eigenvalue.

Every component c counts as the whole number x = floor(scale * c) + shift. Sums are exact; products are made of x less the whole
number nearest its mean, so the covariance is exact as long as its sums of squares stay below 2^53 (and rounds as floats do beyond),
in whatever order partitions arrive. Eigenpairs come from spectrum slicing (`spectrum`) of the one matrix of dims * dims numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import fresh
from tallymark.llm.spectrum import leading

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Whole numbers are cut off here (either sign); only components beyond 2^60 / scale reach it.
LARGEST = 1 << 60
#: Eigenvalues up to this share of the trace count as none: the vectors don't vary in that direction.
NOTHING = 1e-13


def usable(vector: str) -> Column:
    """Whether a vector is not null or empty and holds only finite numbers."""
    v = F.col(f"`{vector}`")
    finite = F.forall(v, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def _vectors(df: DataFrame, vector: str, dims: int) -> DataFrame:
    v = F.col(f"`{vector}`")
    return df.filter(usable(vector) & (F.size(v) == dims)).select(v.cast("array<double>").alias("v"))


def _whole(column: pa.Array, dims: int, scale: int, shift: int) -> np.ndarray:
    values = np.asarray(column.flatten(), np.float64).reshape(-1, dims)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype(np.int64) + shift


@dataclass
class Whitening:
    """n vectors with per-dimension sums, and the components that vary: eigenvalues, eigenvectors (rows), share of the trace."""

    dims: int
    scale: int
    shift: int
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def __post_init__(self):
        self.centre = np.array([round(s / self.n) if abs(s) < 1 << 52 else (2 * s + self.n) // (2 * self.n) for s in self.sums], np.int64)
        #: what is left of the sums once the centre is taken off: at most n / 2 or little more
        self.rest = [s - self.n * int(c) for s, c in zip(self.sums, self.centre)]

    def apart(self, column: pa.Array) -> np.ndarray:
        """x less the centre, as whole numbers."""
        return _whole(column, self.dims, self.scale, self.shift) - self.centre

    def project(self, apart: np.ndarray) -> np.ndarray:
        away = apart - np.array([r / self.n for r in self.rest])
        return (away @ self.vectors.T) / np.sqrt(self.values)

    def deviations(self, apart: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n * x - sum)^2, exact; none where it does not fit 64 bits."""
        most = self.n * int(np.abs(apart).max(initial=0)) + max(map(abs, self.rest))
        if most * most * self.dims < 1 << 63:
            return ((apart * self.n - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * x - r) ** 2 for x, r in zip(row, self.rest)) for row in apart.tolist()]
        return [v if v < 1 << 63 else None for v in exact]


def _sums(rows: DataFrame, dims: int, scale: int, shift: int) -> tuple[int, list[int]]:
    """The number of vectors and the exact sums of their whole numbers; a task reports once."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dims
        for batch in them:
            x = _whole(batch.column(0), dims, scale, shift)
            if len(x):
                n += len(x)
                wide = int(np.abs(x).max()) * len(x) >= 1 << 62
                total = [a + int(b) for a, b in zip(total, x.astype(object).sum(axis=0) if wide else x.sum(axis=0))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))],
                names=["i", "n", "total"],
            )

    parts = rows.mapInArrow(batches, "i int, n bigint, total decimal(38,0)")
    found = parts.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()
    return (found[0]["n"] if found else 0), [int(r["total"]) for r in found]


def _products(rows: DataFrame, dims: int, width: int, centred) -> np.ndarray:
    """The sum of the outer products of `centred` (a function of an Arrow column to a matrix of `width` columns) over all rows.

    A task adds up its own matrix and reports it once; entries are added by place, so no task holds more than a few matrices.
    """
    upper = np.triu_indices(width)

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in them:
            if batch.num_rows:
                y = centred(batch.column(0))
                total += y.T @ y
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(total[upper])], names=["i", "j", "v"])

    out = np.zeros((width, width))
    for r in rows.mapInArrow(batches, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """The whitening of all usable vectors of `df`, or None if there are none.

    Vectors that are null, empty or hold null or non-finite entries take no part. If their lengths differ, those of the most frequent
    length do (of equally frequent ones the longest). Repeated rows count as often as they occur. Directions without variance are no
    components, so there can be fewer than asked for. The covariance (dims * dims numbers) is all that the driver holds.
    """
    v = F.col(f"`{vector}`")
    lengths = df.filter(usable(vector)).groupBy(F.size(v).alias("dims")).count()
    usual = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
    if usual is None:
        return None
    dims = usual["dims"]
    rows = _vectors(df, vector, dims)
    n, sums = _sums(rows, dims, scale, shift)
    none = np.zeros(0)
    plain = Whitening(dims, scale, shift, n, sums, none, np.zeros((0, dims)), none)
    products = _products(rows, dims, dims, lambda column: plain.apart(column).astype(np.float64))
    covariance = np.array([[(n * int(products[i, j]) - plain.rest[i] * plain.rest[j]) / (n * n) for j in range(dims)] for i in range(dims)])
    trace = float(np.trace(covariance))
    values, vectors = leading(covariance, components) if trace > 0 else (none, plain.vectors)
    kept = values > NOTHING * trace
    model = Whitening(dims, scale, shift, n, sums, values[kept], vectors[kept], values[kept] / trace if trace > 0 else none)
    if kept.any():
        squares = _products(rows, dims, int(kept.sum()), lambda column: model.project(model.apart(column)))
        model.identity_error = float(np.abs(squares / n - np.eye(len(squares))).max())
    return model


def transform(df: DataFrame, model: Whitening | None, vector: str = "embedding", out: str = "whitened", deviation: str = "deviation") -> DataFrame:
    """The rows of `df` whose vectors take part, with their whitened components (an array) and exact squared deviation.

    Rows whose vector is unusable or of another length than the model's are left out; without a model all are. Columns of `df` named
    like the results are replaced. Rows don't move.
    """
    base = df.drop(*[c for c in df.columns if c.lower() in (out.lower(), deviation.lower()) and c != vector])
    extra = [T.StructField(out, T.ArrayType(T.DoubleType())), T.StructField(deviation, T.LongType())]
    names = [*base.columns, out, deviation]
    v = F.col(f"`{vector}`")
    if model is None:
        rows = base.filter(F.lit(False))
        return rows.withColumns({out: F.lit(None).cast("array<double>"), deviation: F.lit(None).cast("bigint")})

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            if not batch.num_rows:
                continue
            values = batch.column(batch.num_columns - 1)
            apart = model.apart(values)
            z = model.project(apart)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(model.deviations(apart), pa.int64())], names=names)

    numbers = v.cast("array<double>").alias(fresh("numbers", base.columns))
    chosen = base.filter(usable(vector) & (F.size(v) == model.dims)).select(*[F.col(f"`{c}`") for c in base.columns], numbers)
    return chosen.mapInArrow(batches, T.StructType([*base.schema.fields, *extra]))


def embeddings_whitened(embeddings: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained and identity_error of each usable vector and component."""
    model = fit(embeddings)
    rows = transform(embeddings.select("vec_id", "embedding"), model)
    shares = F.array(*[F.lit(float(e)) for e in model.explained]) if model and len(model.explained) else F.array().cast("array<double>")
    each = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )
