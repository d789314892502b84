"""Hierarchical beta-binomial shrinkage: each group's rate is drawn towards its parent's, the more the fewer outcomes it has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import joined_small, saved

#: Bounds of a level's prior strength (outcomes that the parent's rate counts as), and the strength where nothing can be learned.
WEAKEST, STRONGEST, UNKNOWN = 1.0, 1000.0, 10.0


def strength(spread: float | None, expected: float | None, weight: float | None) -> float:
    """Prior strength by moments: the groups' squared distances from their parents' rates give the intra-class correlation."""
    if not weight:
        return UNKNOWN
    correlation = (spread - expected) / weight
    if correlation <= 0:
        return STRONGEST
    return min(max(1.0 / correlation - 1.0, WEAKEST), STRONGEST)


def posteriors(groups: DataFrame, levels: Sequence[str], n: str = "n", bad: str = "bad") -> DataFrame:
    """Beta posteriors of the finest groups.

    `groups` has one row for each combination of `levels` (coarse to fine, no nulls) with its outcomes `n` and bad outcomes `bad`;
    groups without outcomes keep their parent's rate. Result: levels, n, bad, `alpha`, `beta`. A group's prior is its parent's
    posterior without the group's own outcomes, so no outcome counts twice. Each level is one grouped aggregation; only its
    strength (three sums) and the total reach the driver. Without any outcome the global rate is one half.
    """
    total = groups.agg(F.sum(n), F.sum(bad)).first()
    top = {"above_bad": F.lit((total[1] or 0) + 0.5), "above": F.lit((total[0] or 0) + 1.0)}
    parent, found = None, None
    for i in range(len(levels)):
        keys = list(levels[: i + 1])
        level = groups.groupBy(*keys).agg(F.sum(n).alias(n), F.sum(bad).alias(bad)) if i + 1 < len(levels) else groups.select(*keys, n, bad)
        level = level.withColumns(top) if parent is None else joined_small(level, parent, keys[:-1])
        own = (F.col("above_bad") - F.col(bad)) / (F.col("above") - F.col(n))
        level = saved(level.withColumn("mean", own), "shrinkage")
        m, count = F.col("mean"), F.col(n)
        sums = level.filter(count > 0).agg(
            F.sum(count * F.pow(F.col(bad) / count - m, F.lit(2.0))),
            F.sum(m * (1 - m)),
            F.sum(m * (1 - m) * (count - 1)),
        ).first()
        s = strength(*sums)
        found = level.select(
            *keys, n, bad, (m * s + F.col(bad)).alias("alpha"), ((1 - m) * s + count - F.col(bad)).alias("beta")
        )
        parent = found.select(*keys, F.col("alpha").alias("above_bad"), (F.col("alpha") + F.col("beta")).alias("above"))
    return found


def lower_bound(z: float):
    """The posterior mean less `z` posterior deviations, not under 0."""
    a, b = F.col("alpha"), F.col("beta")
    mean = a / (a + b)
    return F.greatest(mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1)), F.lit(0.0))
