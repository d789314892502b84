"""Maps from scores to probabilities: a monotone one of any number of steps, and a one-feature logistic curve.

The monotone map pools adjacent violators inside value ranges, one task a range, and moves the ranges until no neighbours violate the
order, so neither a task nor the driver ever holds more than a bounded number of points, whatever the scores look like.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tallymark.functions.columns import quoted
from tallymark.operators.ordering import attach, settle
from tallymark.session import shared_dir

RANGE_ROWS = 200_000  # points of a value range, which one task pools
LOCAL_BLOCKS = 50_000  # most blocks of a map that the driver holds and every task is given
STEPS = 50  # Newton steps of the logistic curve
ENOUGH = 1e-14  # relative change of the loss at which the curve is done


def _usable(df: DataFrame, score: str) -> Column:
    x = F.col(quoted(score)).cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def _ranged(df: DataFrame, x: str, parts: int, shift: float = 0.0) -> DataFrame:
    """``df`` with the number ``__part`` of its value range; ranges hold about equally many rows."""
    cuts: list[float] = []
    if parts > 1:
        probs = [(i + shift) / parts for i in range(parts + 1) if 0 < (i + shift) / parts < 1]
        cuts = sorted(set(df.approxQuantile(x, probs, 1 / (20 * parts))))
    splits = [float("-inf"), *[c + 0.0 for c in cuts if math.isfinite(c)], float("inf")]
    if len(splits) < 3:
        return df.withColumn("__part", F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=x, outputCol="__part").transform(df)


def pool_adjacent(points: pd.DataFrame) -> pd.DataFrame:
    """Blocks ``lo, hi, w, s`` with rising means ``s / w`` from such blocks in any order; their ranges do not overlap."""
    points = points.sort_values("lo")
    lo, hi, w, s = [], [], [], []
    for a, b, weight, total in zip(*(points[c].tolist() for c in ("lo", "hi", "w", "s"))):
        while w and s[-1] * weight >= total * w[-1]:
            a, weight, total = lo.pop(), weight + w.pop(), total + s.pop()
            hi.pop()
        lo.append(a), hi.append(b), w.append(weight), s.append(total)
    return pd.DataFrame({"lo": lo, "hi": hi, "w": w, "s": s}, dtype="float64")


def _out_of_order(blocks: DataFrame) -> bool:
    """Whether the last block of a range is not below the first one of the next; one row a range on the driver."""
    mean = F.col("s") / F.col("w")
    ends = blocks.groupBy("__part").agg(F.min_by(mean, "lo").alias("first"), F.max_by(mean, "lo").alias("last")).collect()
    ends = sorted(ends, key=lambda r: r["__part"])
    return any(a["last"] >= b["first"] for a, b in zip(ends, ends[1:]))


@dataclass(frozen=True)
class MonotoneMap:
    """Blocks ``lo, hi, value`` of rising values; between two blocks the value is interpolated, beyond the outer ones it stays."""

    blocks: DataFrame
    size: int
    score: str
    out: str

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the column ``out``; a missing score has none, nor has any score on a map learned from no rows."""
        if self.size <= LOCAL_BLOCKS:
            return self._by_local_map(df)
        return self._by_ranges(df)

    def _by_local_map(self, df: DataFrame) -> DataFrame:
        kept = self.blocks.orderBy("lo").toPandas()
        if kept.empty:
            return df.withColumn(self.out, F.lit(None).cast("double"))
        xs, values = kept[["lo", "hi"]].to_numpy().ravel(), np.repeat(kept["value"].to_numpy(), 2)

        @F.pandas_udf("double")
        def look_up(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for x in batches:
                yield pd.Series(np.interp(x.to_numpy(np.float64), xs, values)).where(x.notna().to_numpy())

        return df.withColumn(self.out, look_up(F.col(quoted(self.score)).cast("double")))

    def _by_ranges(self, df: DataFrame) -> DataFrame:
        """Different scores and block ends meet in value ranges; every range is told the last end before and the first behind it."""
        x = F.col(quoted(self.score)).cast("double")
        asked = df.filter(_usable(df, self.score)).select(x.alias("x")).distinct().select("x", F.lit(None).cast("double").alias("v"))
        ends = self.blocks.select(F.explode(F.array("lo", "hi")).alias("x"), F.col("value").alias("v")).distinct()
        points = asked.unionByName(ends).checkpoint()
        parts = max(1, -(-points.count() // RANGE_ROWS))
        ranged = _ranged(points, "x", parts).withColumn("end", F.when(F.col("v").isNotNull(), F.struct("x", "v")))
        outer = ranged.groupBy("__part").agg(F.min("end").alias("low"), F.max("end").alias("high"))
        order = W.orderBy("__part")  # one row a range
        outer = settle(outer.select(
            "__part",
            F.last("high", True).over(order.rowsBetween(W.unboundedPreceding, -1)).alias("before"),
            F.first("low", True).over(order.rowsBetween(1, W.unboundedFollowing)).alias("behind"),
        ))
        inside = W.partitionBy("__part").orderBy("x")
        near = attach(ranged, outer, ["__part"], ["before", "behind"]).select(
            "x", "v",
            F.coalesce(F.last("end", True).over(inside.rangeBetween(W.unboundedPreceding, W.currentRow)), "before").alias("a"),
            F.coalesce(F.first("end", True).over(inside.rangeBetween(W.currentRow, W.unboundedFollowing)), "behind").alias("b"),
        )
        slope = (F.col("b.v") - F.col("a.v")) / (F.col("b.x") - F.col("a.x"))
        value = F.when(F.col("a").isNull(), F.col("b.v")).when(F.col("b").isNull() | (F.col("a.x") == F.col("b.x")), F.col("a.v"))
        found = near.filter("v IS NULL").select(
            F.col("x").alias("__x"), value.otherwise(F.col("a.v") + slope * (F.col("x") - F.col("a.x"))).alias(self.out)
        )
        first, last = self.blocks.agg(F.min("value"), F.max("value")).first()
        joined = df.drop(self.out).withColumn("__x", F.when(_usable(df, self.score), x)).join(found, "__x", "left")
        beyond = F.when(x == float("-inf"), F.lit(first)).when(x == float("inf"), F.lit(last))
        return joined.withColumn(self.out, F.coalesce(self.out, beyond)).drop("__x")


def isotonic(train: DataFrame, y: str = "label", score: str = "score", weight: str | None = None, out: str = "calibrated") -> MonotoneMap:
    """The non-decreasing map from score to the weighted mean of ``y`` with the least squared error.

    Rows without a finite score, without a label or without a positive weight take no part. Equal scores are pooled before they are
    shuffled. A round pools the points of each value range; the next one moves the ranges by half, so that a pair out of order at a
    border is inside a range. Two rounds without a change leave no such pair, and a round never adds points.
    """
    shared_dir(train.sparkSession)
    w = F.lit(1.0) if weight is None else F.col(quoted(weight)).cast("double")
    x, label = F.col(quoted(score)).cast("double"), F.col(quoted(y)).cast("double")
    rows = train.filter(_usable(train, score) & label.isNotNull() & (w > 0)).select((x + 0.0).alias("lo"), w.alias("w"), (w * label).alias("s"))
    points = rows.groupBy("lo").agg(F.sum("w").alias("w"), F.sum("s").alias("s"))
    blocks = points.select("lo", F.col("lo").alias("hi"), "w", "s").checkpoint()
    n, shift, wide = blocks.count(), 0.0, 1
    while n:
        parts = -(-n // (RANGE_ROWS * wide))
        ranged = _ranged(blocks, "lo", parts, shift)
        pooled = ranged.groupBy("__part").applyInPandas(_pool_range, "lo double, hi double, w double, s double, __part double").checkpoint()
        before, blocks, n, shift = n, pooled.drop("__part"), pooled.count(), 0.5 - shift
        wide = 1 if n < before else wide * 2  # borders that fell on the same place twice
        if parts == 1 or not _out_of_order(pooled):
            break
    return MonotoneMap(blocks.select("lo", "hi", (F.col("s") / F.col("w")).alias("value")), n, score, out)


def _pool_range(points: pd.DataFrame) -> pd.DataFrame:
    return pool_adjacent(points).assign(__part=float(points["__part"].iloc[0]))


@dataclass(frozen=True)
class LogisticCurve:
    """Probability ``1 / (1 + exp(-(slope * score + intercept)))``."""

    slope: float
    intercept: float
    score: str
    out: str

    def transform(self, df: DataFrame) -> DataFrame:
        margin = F.col(quoted(self.score)).cast("double") * F.lit(self.slope) + F.lit(self.intercept)
        return df.withColumn(self.out, F.lit(1.0) / (F.lit(1.0) + F.exp(-margin)))


def platt(train: DataFrame, y: str = "label", score: str = "score", out: str = "calibrated", steps: int = STEPS) -> LogisticCurve:
    """A logistic curve over one score, fitted by Newton steps with one small aggregate each.

    The targets are (n1 + 1) / (n1 + 2) for the n1 positive rows and 1 / (n0 + 2) for the n0 others, so that the curve stays finite where
    the score separates the classes. Rows without a finite score or a label take no part; without any row, or where all scores are
    equal, the slope is 0.
    """
    shared_dir(train.sparkSession)
    x, positive = F.col(quoted(score)).cast("double"), F.col(quoted(y)).cast("double") > 0.5
    rows = train.filter(_usable(train, score) & F.col(quoted(y)).isNotNull())
    cells = rows.groupBy(x.alias("x")).agg(F.count_if(positive).cast("double").alias("n1"), F.count_if(~positive).cast("double").alias("n0")).checkpoint()
    n = F.col("n1") + F.col("n0")
    n1, n0, total = cells.agg(F.sum("n1"), F.sum("n0"), F.sum(n * F.col("x"))).first()
    if not n1 and not n0:
        return LogisticCurve(0.0, 0.0, score, out)
    centre = total / (n1 + n0)
    spread = math.sqrt(cells.agg(F.sum(n * (F.col("x") - centre) ** 2)).first()[0] / (n1 + n0))
    high, low = (n1 + 1) / (n1 + 2), 1 / (n0 + 2)
    if spread == 0:
        share = (n1 * high + n0 * low) / (n1 + n0)
        return LogisticCurve(0.0, math.log(share / (1 - share)), score, out)
    z, aim = (F.col("x") - centre) / spread, F.col("n1") * high + F.col("n0") * low
    at, best, step = (0.0, 0.0), None, (0.0, 0.0)
    for _ in range(steps):
        margin = z * at[0] + at[1]
        p = 1 / (1 + F.exp(-margin))
        bend = n * p * (1 - p)
        # log(1 + exp(m)) without overflow
        soft = F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin)))
        loss, g1, g0, h11, h10, h00 = cells.agg(
            F.sum(n * soft - aim * margin), F.sum((n * p - aim) * z), F.sum(n * p - aim),
            F.sum(bend * z * z), F.sum(bend * z), F.sum(bend),
        ).first()
        if best is not None and not loss <= best[0]:
            if max(map(abs, step)) <= 1e-12 * (1 + max(map(abs, at))):
                break
            step = (step[0] / 2, step[1] / 2)
        else:
            done = best is not None and best[0] - loss <= ENOUGH * abs(loss)
            best, det = (loss, at), h11 * h00 - h10 * h10
            if done or not det > 0:
                break
            step = ((h00 * g1 - h10 * g0) / det, (h11 * g0 - h10 * g1) / det)
        at = (best[1][0] - step[0], best[1][1] - step[1])
    slope, intercept = best[1]
    return LogisticCurve(slope / spread, intercept - slope * centre / spread, score, out)
