"""Univariate profiles: summary statistics, histograms, densities and box-plot statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import bin_index
from tallymark.operators.ordering import (
    attach,
    most_frequent,
    order_stats,
    settle,
)

STEPS_PER_BANDWIDTH = 400  # density bins in one bandwidth
REACH = 9.0  # bandwidths beyond which the kernel is nothing


def _named(values: str, names: Sequence[str]) -> list[Column]:
    return [F.get(F.col(values), F.lit(i)).alias(name) for i, name in enumerate(names)]


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, min, exact quartiles and max of the non-missing values."""
    stats = order_stats(
        df, cols, [0.25, 0.5, 0.75], by, {"mean": "avg({x})", "std": "stddev_samp({x})"}
    )
    return stats.select(
        *by, "column", "count", "mean", "std", "min",
        *_named("quantiles", ["p25", "p50", "p75"]), "max",
    )


def box_stats(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), whisker: float = 1.5
) -> DataFrame:
    """Quartiles, whisker ends (most extreme values within the fences) and outlier count."""
    by = list(by)
    quartiles = settle(
        order_stats(df, cols, [0.25, 0.5, 0.75], by).select(
            *by, "column", "count", *_named("quantiles", ["q1", "median", "q3"])
        )
    )
    reach = F.lit(float(whisker)) * (F.col("q3") - F.col("q1"))
    fences = quartiles.frame.select(
        "*", (F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high")
    )
    per_group = settle(
        fences.groupBy(*by).agg(F.map_from_entries(F.collect_list(
            F.struct("column", F.struct("low", "high"))
        )).alias("__f"))
    )
    rows = attach(df.select(*by, *[c for c in cols if c not in by]), per_group, by, ["__f"]) if by else df
    fixed = {} if by else {r["column"]: r for r in fences.collect()}
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        if by:
            low, high = F.col("__f")[c]["low"], F.col("__f")[c]["high"]
        else:
            low, high = (F.lit(fixed[c][e]).cast("double") for e in ("low", "high"))
        aggs += [
            F.min(F.when(x >= low, x)).alias(f"lo{i}"),
            F.max(F.when(x <= high, x)).alias(f"hi{i}"),
            F.count(F.when((x < low) | (x > high), 1)).alias(f"out{i}"),
        ]
    wide = rows.groupBy(*by).agg(*aggs) if by else rows.agg(*aggs)
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"lo{i}").alias("whisker_low"),
                F.col(f"hi{i}").alias("whisker_high"),
                F.col(f"out{i}").alias("outliers"),
            )
            for i, c in enumerate(cols)
        ]
    )
    ends = settle(wide.select(*by, F.explode(cells).alias("p")).select(*by, "p.*"))
    joined = attach(
        quartiles.frame, ends, [*by, "column"], ["whisker_low", "whisker_high", "outliers"]
    )
    return joined.select(
        *by, "column", "count", "q1", "median", "q3", "whisker_low", "whisker_high", "outliers"
    )


def automatic_bins(n: int, spread: float, iqr: float) -> int:
    """The larger of the Sturges and the Freedman-Diaconis bin counts."""
    if n == 0 or spread <= 0:
        return 1
    widths = [spread / (math.log2(n) + 1.0)]
    if iqr > 0:
        widths.append(2.0 * iqr / n ** (1.0 / 3.0))
    return max(1, math.ceil(spread / min(widths)))


def histogram(
    df: DataFrame, c: str, bins: int | str = "auto", by: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins with their counts: ``by…, bin, low, high, n``.

    Empty bins are left out of grouped histograms and where the number of bins is automatic (one extreme
    value makes it as large as it likes); with a given number of bins they are kept.
    """
    by, sparse = list(by), bins == "auto" or bool(by)
    stats = order_stats(df, [c], [0.25, 0.75] if bins == "auto" else []).first()
    n, low, high = stats["count"], stats["min"], stats["max"]
    if n == 0:
        low = high = 0.0
    if bins == "auto":
        q1, q3 = stats["quantiles"]
        bins = automatic_bins(n, high - low, (q3 or 0.0) - (q1 or 0.0))
    width = (high - low) / bins
    counted = (
        df.filter(F.col(c).isNotNull())
        .groupBy(*by, bin_index(c, low, width, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edge = lambda i: F.lit(low) + F.lit(width) * i
    if not sparse:
        every = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
        counted = every.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.select(
        *by, "bin", edge(F.col("bin")).alias("low"), edge(F.col("bin") + 1).alias("high"), "n"
    )


def kde(df: DataFrame, c: str, grid: int = 20, bandwidth: float | str = "scott") -> DataFrame:
    """Gaussian kernel density on an even grid: ``x, density``.

    Rows are added up in bins of a small share of the bandwidth, with their first two moments, and a bin only meets the grid points
    within ``REACH`` bandwidths. The third-order rest is below 3e-10 of the kernel's height a row, beyond the reach 3e-18 are left out.
    One aggregate over the rows, whatever the grid.
    """
    x = F.col(c).cast("double")
    s = df.agg(
        F.count(x).alias("n"), F.min(x).alias("low"), F.max(x).alias("high"),
        F.stddev_samp(x).alias("std"),
    ).first()
    n = s["n"]
    h = s["std"] * n ** (-0.2) if bandwidth == "scott" and n > 1 else bandwidth
    if n == 0 or isinstance(h, str) or h <= 0:
        raise ValueError(f"{c!r} has no spread to estimate a density from")
    step = (s["high"] - s["low"]) / max(grid - 1, 1)
    width = h / STEPS_PER_BANDWIDTH
    place = F.floor((x - s["low"]) / width)
    u = (x - (F.col("bin") + 0.5) * width - s["low"]) / h  # distance from the middle of the bin, in bandwidths
    bins = df.filter(x.isNotNull()).withColumn("bin", place).groupBy("bin").agg(
        F.count(F.lit(1)).alias("m0"), F.sum(u).alias("m1"), F.sum(u * u).alias("m2")
    )
    middle = s["low"] + (F.col("bin") + 0.5) * width
    reach = F.lit(REACH * h)
    if step > 0:
        first = F.greatest(F.ceil((middle - reach - s["low"]) / step), F.lit(0))
        last = F.least(F.floor((middle + reach - s["low"]) / step), F.lit(grid - 1))
        met = bins.withColumn("g", F.when(first <= last, F.sequence(first, last)))
    else:
        met = bins.withColumn("g", F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint")))
    z = (F.col("g") * step + s["low"] - middle) / h
    met = met.withColumn("g", F.explode("g")).withColumn("z", z)
    # the kernel at z - u by its Taylor series around z
    part = F.exp(-0.5 * F.col("z") ** 2) * (F.col("m0") + F.col("z") * F.col("m1") + (F.col("z") ** 2 - 1) * F.col("m2") / 2)
    sums = met.groupBy("g").agg(F.sum(part).alias("v"))
    every = df.sparkSession.range(grid).join(sums, F.col("id") == F.col("g"), "left")
    scale = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    return every.select((F.col("id") * step + s["low"]).alias("x"), (F.coalesce("v", F.lit(0.0)) * scale).alias("density"))


def moments(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Skewness and kurtosis (population), sample variance, range and mode per column."""
    shapes = order_stats(
        df, cols, [], (),
        {"skewness": "skewness({x})", "kurtosis": "kurtosis({x})", "variance": "var_samp({x})"},
    )
    modes = most_frequent(df, cols).select(
        F.col("column").alias("__c"), F.col("value").cast("double").alias("mode")
    )
    joined = shapes.join(modes, shapes["column"] == modes["__c"], "left")
    return joined.select(
        "column", "skewness", "kurtosis", "variance",
        (F.col("max") - F.col("min")).alias("range"), "mode",
    )
