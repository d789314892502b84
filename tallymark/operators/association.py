"""Bivariate and multivariate summaries: correlations, crosstabs, rates and binned scatters."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import bin_index, quoted
from tallymark.operators.ordering import order_stats, sample_rows
from tallymark.operators.quality import percent
from tallymark.session import shared_dir

WIDE = 24  # columns up to which every pair is an aggregate of its own
GRAM = ["i", "j", "n", "x", "y", "xx", "yy", "xy"]
GRAM_DDL = "i int, j int, n double, x double, y double, xx double, yy double, xy double"
GRAM_TASKS = 10_000  # most tasks that report a matrix
UNSURE = 1e-8  # share of a column's squared distances that its spread has to reach
PAIRS_PER_PASS = 200
MAX_COLUMNS = 1000  # most columns a pivoted table gets unless the caller allows more


def _corr(a: str, b: str) -> Column:
    """Pearson over the rows where both are present; no spread gives null."""
    x, y = f"double({quoted(a)})", f"double({quoted(b)})"
    return F.expr(
        f"try_divide(covar_pop({x}, {y}), stddev_pop(if({y} IS NULL, NULL, {x})) * "
        f"stddev_pop(if({x} IS NULL, NULL, {y})))"
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pairwise-complete Pearson matrix in long form ``a, b, r``.

    Few columns are one aggregate; more than ``WIDE`` go through matrix products (``corr_blocks``).
    """
    if len(cols) > WIDE:
        return corr_blocks(df, cols)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    wide = df.agg(
        *[_corr(a, b).alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
        *[F.var_pop(F.col(quoted(c)).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)],
    )
    cell = lambda a, b, r: F.struct(
        F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r")
    )
    cells = [cell(c, c, F.when(F.col(f"v{i}") > 0, F.lit(1.0))) for i, c in enumerate(cols)]
    for i, (a, b) in enumerate(pairs):
        cells += [cell(a, b, F.col(f"r{i}")), cell(b, a, F.col(f"r{i}"))]
    return wide.select(F.explode(F.array(*cells)).alias("p")).select("p.*")


def _gram_sums(batches: Iterator[pa.RecordBatch], centre: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One task's sums over the rows where both columns are present, a row ``i, j, n, x, y, xx, yy, xy`` for each i <= j.

    Values are taken less ``centre``, one number a column, so that the products don't cancel.
    """
    width = len(centre)
    n, first, square, cross = (np.zeros((width, width)) for _ in range(4))
    for batch in batches:
        x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
        there = ~np.isnan(x)
        x, there = np.where(there, x - centre, 0.0), there.astype(np.float64)
        n += there.T @ there
        first += x.T @ there
        square += (x * x).T @ there
        cross += x.T @ x
    i, j = np.triu_indices(width)
    sums = [n[i, j], first[i, j], first[j, i], square[i, j], square[j, i], cross[i, j]]
    yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), *map(pa.array, sums)], names=GRAM)


def corr_blocks(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``corr_matrix`` by masked matrix products of Arrow batches: one pass for the means, one for all pairs.

    A task holds four matrices of columns x columns numbers and reports once, however many rows it reads; Spark adds the reports of at
    most ``GRAM_TASKS`` tasks. Pairs for which the sums say too little (a spread that is tiny against the distance from the mean, or a
    value that is not finite) are aggregated one by one.
    """
    cols = list(cols)
    shared_dir(df.sparkSession)
    values = df.select(*[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    odd = lambda c: F.isnan(c) | (F.abs(c) == float("inf"))
    told = values.agg(*[F.avg(F.when(~odd(F.col(c)), F.col(c))).alias(c) for c in values.columns], *[F.max(odd(F.col(c))).alias(f"o{c}") for c in values.columns]).first()
    centre = np.array([told[f"c{i}"] or 0.0 for i in range(len(cols))])
    plain = [i for i in range(len(cols)) if not told[f"oc{i}"]]
    kept, shift = values.select(*[f"c{i}" for i in plain]), centre[plain]
    spark, width = df.sparkSession, len(plain)
    none = spark.range(width * width).selectExpr(f"int(id div {max(width, 1)}) AS i", f"int(id % {max(width, 1)}) AS j", *[f"0D AS {c}" for c in GRAM[2:]])
    sums = none.filter("i <= j")  # a table without rows has no tasks that report
    if plain:
        sums = sums.unionByName(kept.coalesce(GRAM_TASKS).mapInArrow(lambda batches: _gram_sums(batches, shift), GRAM_DDL))
    added = sums.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in GRAM[2:]])
    spread = added.selectExpr("*", "xx - try_divide(x * x, n) AS vx", "yy - try_divide(y * y, n) AS vy", "xy - try_divide(x * y, n) AS vxy")
    number = F.array(*[F.lit(i) for i in plain]) if plain else F.array(F.lit(0))
    found = spread.select(
        F.get(number, "i").alias("i"), F.get(number, "j").alias("j"), F.expr("if(i = j, 1D, try_divide(vxy, sqrt(vx) * sqrt(vy)))").alias("r"),
        F.expr(f"n > 0 AND (vx <= {UNSURE!r}D * xx OR vy <= {UNSURE!r}D * yy)").alias("unsure"), F.expr("n = 0").alias("none"),
    ).checkpoint()
    named = F.array(*[F.lit(c) for c in cols])
    cells = found.filter("NOT unsure").select("i", "j", F.expr("if(none, NULL, r)").alias("r"))
    again = [(r["i"], r["j"]) for r in found.filter("unsure").select("i", "j").collect()]
    again += [(min(i, j), max(i, j)) for i in range(len(cols)) if told[f"oc{i}"] for j in range(len(cols)) if j <= i or not told[f"oc{j}"]]
    for start in range(0, len(again), PAIRS_PER_PASS):
        some = again[start : start + PAIRS_PER_PASS]
        one = lambda i, j: F.expr(f"if(var_pop(c{i}) > 0, 1D, NULL)") if i == j else _corr(f"c{i}", f"c{j}")
        wide = values.agg(*[one(i, j).alias(f"r{k}") for k, (i, j) in enumerate(some)])
        listed = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"r{k}").alias("r")) for k, (i, j) in enumerate(some)]
        cells = cells.unionByName(wide.select(F.explode(F.array(*listed)).alias("p")).select("p.*"))
    both = F.expr("if(i = j, array(struct(i, j)), array(struct(i, j), struct(j AS i, i AS j)))")
    return cells.select("r", F.explode(both).alias("p")).select(F.get(named, "p.i").alias("a"), F.get(named, "p.j").alias("b"), "r")


def target_corr(
    df: DataFrame, cols: Sequence[str], y: str, decimals: int | None = 3
) -> DataFrame:
    """Correlation of each column with the class code, ascending."""
    wide = df.agg(*[_corr(c, y).alias(f"r{i}") for i, c in enumerate(cols)])
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"r{i}").alias("r"))
            for i, c in enumerate(cols)
        ]
    )
    long = wide.select(F.explode(cells).alias("p")).select("p.*").orderBy("r", "column")
    return long if decimals is None else long.withColumn("r", F.round("r", decimals))


def rank_association(
    train: DataFrame, cols: Sequence[str], y: str, decimals: int | None = None
) -> DataFrame:
    """Absolute correlation with the label on training rows, strongest first."""
    strength = F.abs("r") if decimals is None else F.round(F.abs("r"), decimals)
    return (
        target_corr(train, cols, y, None)
        .orderBy(F.abs("r").desc_nulls_last(), "column")
        .select("column", strength.alias("abs_r"))
    )


def distinct_values(df: DataFrame, c: str) -> DataFrame:
    return df.select(c).distinct()


def _value_list(df: DataFrame, c: str, most: int) -> list:
    rows = df.filter(F.col(c).isNotNull()).select(c).distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{c!r} has more than {most} values: raise max_columns or use the long form (crosstab_long)")
    return sorted(r[0] for r in rows)


def two_way_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows per pair of values, missing keys left out."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(
        F.count(F.lit(1)).alias("n")
    )


def crosstab_long(df: DataFrame, row: str, col: str, decimals: int | None = 2) -> DataFrame:
    """``row, col, n, pct`` of the pairs that occur, ``pct`` within each row value; any number of values."""
    counts = two_way_counts(df, row, col)
    whole = counts.groupBy(row).agg(F.sum("n").alias("__n"))
    return counts.join(whole, row).select(row, col, "n", percent(F.col("n"), F.col("__n"), decimals).alias("pct"))


def crosstab_pct(
    df: DataFrame, row: str, col: str, values: Sequence | None = None, decimals: int = 2,
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """Percentages within each row value, one column per value of ``col``; absent pairs are 0."""
    present = df.filter(F.col(row).isNotNull() & F.col(col).isNotNull())
    values = list(values) if values is not None else _value_list(present, col, max_columns)
    counts = present.groupBy(row).agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.count(F.when(F.col(col) == v, 1)).alias(f"__v{i}") for i, v in enumerate(values)],
    )
    return counts.select(
        row,
        *[
            percent(F.col(f"__v{i}"), F.col("__n"), decimals).alias(str(v))
            for i, v in enumerate(values)
        ],
    )


def grouped_summary(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], decimals: int | None = 2
) -> DataFrame:
    """Count, mean, median and deviation of every column per group, one row per group and column."""
    stats = order_stats(df, cols, [0.5], by, {"mean": "avg({x})", "std": "stddev_samp({x})"})
    tidy = (lambda c: c) if decimals is None else (lambda c: F.round(c, decimals))
    return stats.select(
        *by, "column", "count", tidy(F.col("mean")).alias("mean"),
        tidy(F.get(F.col("quantiles"), F.lit(0))).alias("median"), tidy(F.col("std")).alias("std"),
    )


def rate_by(
    df: DataFrame, by: Sequence[str], flag: str | Column, decimals: int | None = 2
) -> DataFrame:
    """Rows and percentage of true flags per observed group, missing keys left out."""
    hit = F.col(flag) if isinstance(flag, str) else flag
    rate = F.avg(hit.cast("double")) * F.lit(100.0)
    return (
        df.na.drop(subset=list(by))
        .groupBy(*by)
        .agg(
            F.count(hit).alias("n"),
            (rate if decimals is None else F.round(rate, decimals)).alias("rate"),
        )
    )


def unstack(
    df: DataFrame, row: str | Sequence[str], col: str, value: str, values: Sequence | None = None,
    max_columns: int = MAX_COLUMNS,
) -> DataFrame:
    """A grouped result as a matrix; absent cells stay null."""
    rows = [row] if isinstance(row, str) else list(row)
    values = list(values) if values is not None else _value_list(df, col, max_columns)
    return df.groupBy(*rows).pivot(col, values).agg(F.first(value, ignorenulls=True))


def _ranges(df: DataFrame, cols: Sequence[str]) -> list[tuple[float, float]]:
    s = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{e}{i}") for i, c in enumerate(cols)
          for f, e in ((F.min, "a"), (F.max, "b"))]
    ).first()
    return [(s[f"a{i}"] or 0.0, s[f"b{i}"] or 0.0) for i in range(len(cols))]


def binned_scatter(
    df: DataFrame, x: str, y: str, by: Sequence[str] = (), xbins: int = 20, ybins: int = 20
) -> DataFrame:
    """The table behind a coloured scatter plot: complete rows per cell and class.

    ``by…, xbin, ybin, n, x_mean, y_mean``; its size depends on the bins, not on the rows.
    """
    whole = df.na.drop(subset=[x, y, *by])
    (xlow, xhigh), (ylow, yhigh) = _ranges(whole, [x, y])
    return whole.groupBy(
        *by,
        bin_index(x, xlow, (xhigh - xlow) / xbins, xbins).alias("xbin"),
        bin_index(y, ylow, (yhigh - ylow) / ybins, ybins).alias("ybin"),
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(x).cast("double")).alias("x_mean"),
        F.avg(F.col(y).cast("double")).alias("y_mean"),
    )


def scatter_sample(
    df: DataFrame, cols: Sequence[str], n: int, key: str, seed: int = 42
) -> DataFrame:
    """A reproducible sample of complete rows for point plots."""
    whole = df.na.drop(subset=list(cols)).select(*dict.fromkeys([key, *cols]))
    return sample_rows(whole, n, key, seed)


def pair_summary(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), bins: int = 10
) -> DataFrame:
    """The tables behind a pair plot on complete rows: per class a histogram of each column
    (``a = b``) and binned counts of each pair, ``by…, a, b, abin, bbin, n``."""
    whole = df.na.drop(subset=[*cols, *by])
    spans = _ranges(whole, cols)
    binned = whole.select(
        *by,
        *[
            bin_index(c, low, (high - low) / bins, bins).alias(f"__{i}")
            for i, (c, (low, high)) in enumerate(zip(cols, spans))
        ],
    )
    pairs = combinations_with_replacement(range(len(cols)), 2)
    cells = F.array(
        *[
            F.struct(
                F.lit(cols[i]).alias("a"), F.lit(cols[j]).alias("b"),
                F.col(f"__{i}").alias("abin"), F.col(f"__{j}").alias("bbin"),
            )
            for i, j in pairs
        ]
    )
    # rows that fall into the same bins collapse before they are repeated for every pair
    shared = [f"__{i}" for i in range(len(cols))]
    combined = binned.groupBy(*by, *shared).agg(F.count(F.lit(1)).alias("__n"))
    return (
        combined.select(*by, "__n", F.explode(cells).alias("p"))
        .groupBy(*by, "p.a", "p.b", "p.abin", "p.bbin")
        .agg(F.sum("__n").alias("n"))
    )
