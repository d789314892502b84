"""Paired comparisons of two measurements per group."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.functions import distributions
from tallymark.operators.ordering import running_totals

# the two tail functions travel with the task, so workers need no copy of the package
cloudpickle.register_pickle_by_value(distributions)


def mean_difference(df: DataFrame, by: Sequence[str], a: str, b: str) -> DataFrame:
    """Mean of a - b over complete pairs."""
    d = F.col(a).cast("double") - F.col(b).cast("double")
    return df.groupBy(*by).agg(F.count(d).alias("pairs"), F.avg(d).alias("mean_difference"))


def paired_tests(
    df: DataFrame, by: Sequence[str], a: str, b: str, method: str = "auto", exact_limit: int = 50
) -> DataFrame:
    """Paired t-test and signed-rank test of a against b, one row per group.

    ``by…, pairs, mean_difference, t, paired_t_pvalue, w_plus, w_minus, wilcoxon_pvalue, wilcoxon_method``; a
    test that cannot be made is null. Zero differences are left out of the ranks. ``method`` is "exact" (of groups with ties or zero
    differences only those of at most ``exact_limit`` differences, counted over their mid-ranks; larger ones are null), "normal", or "auto": exact up to ``exact_limit`` differences without ties; ``wilcoxon_method`` tells which one was used. Absolute differences are ranked through their counts and running totals, so
    a group of any size is spread over tasks.
    """
    if not by:
        one = df.select(F.lit(0).alias("__all"), a, b)
        return paired_tests(one, ["__all"], a, b, method, exact_limit).drop("__all")
    if method not in ("auto", "exact", "normal"):
        raise ValueError("method is 'auto', 'exact' or 'normal'")
    by = list(by)
    t_tail = distributions.t_two_sided
    rank_tail = distributions.signed_rank_two_sided
    tied_tail = distributions.tied_signed_rank_two_sided

    @F.pandas_udf("double")
    def t_pvalue(t: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series(
            [t_tail(x, k) if pd.notna(x) else None for x, k in zip(t, dof)], dtype="float64"
        )

    @F.pandas_udf("double")
    def rank_pvalue(w: pd.Series, n: pd.Series, ties: pd.Series, inexact: pd.Series) -> pd.Series:
        return pd.Series(
            [
                rank_tail(float(x), int(m), float(c), bool(e)) if pd.notna(x) else None
                for x, m, c, e in zip(w, n, ties, inexact)
            ],
            dtype="float64",
        )

    @F.pandas_udf("double")
    def tied_pvalue(w: pd.Series, ranks: pd.Series, counts: pd.Series) -> pd.Series:
        return pd.Series(
            [
                tied_tail(float(x), [int(v) for v in r], [int(v) for v in c]) if pd.notna(x) and r is not None else None
                for x, r, c in zip(w, ranks, counts)
            ],
            dtype="float64",
        )

    diffs = df.select(
        *by, (F.col(a).cast("double") - F.col(b).cast("double")).alias("d")
    ).filter(F.col("d").isNotNull())
    sizes = F.abs("d").alias("size")
    cells = diffs.groupBy(*by, sizes).agg(
        F.count(F.lit(1)).alias("all"),
        F.count(F.when(F.col("d") > 0, 1)).alias("up"),
        F.count(F.when(F.col("d") < 0, 1)).alias("down"),
    )
    ranked = running_totals(
        cells.filter(F.col("size") > 0), "size", ["all"], by, rows=diffs.count()
    )
    count = F.col("all").cast("double")
    rank = F.col("cum_all") - count + (count + 1.0) / 2.0
    ranks = ranked.groupBy(*by).agg(
        F.sum("all").alias("nonzero"),
        F.sum(rank * F.col("up")).alias("w_plus"),
        F.sum(rank * F.col("down")).alias("w_minus"),
        F.sum(count * count * count - count).alias("ties"),
        F.max("all").alias("largest"),
        # whole for groups of at most exact_limit differences, and never longer than that
        F.collect_list(
            F.when(F.col("cum_all") <= exact_limit, F.struct((2 * rank).cast("bigint").alias("rank"), F.col("all").alias("count")))
        ).alias("cells"),
    )
    means = diffs.groupBy(*by).agg(
        F.count("d").alias("pairs"),
        F.avg("d").alias("mean_difference"),
        F.stddev_samp("d").alias("std"),
    )
    right = ranks.select(
        *[F.col(c).alias(f"__by_{c}") for c in by], *[c for c in ranks.columns if c not in by]
    )
    joined = means.join(right, [means[c].eqNullSafe(right[f"__by_{c}"]) for c in by], "left")
    t = F.when(
        F.col("std") > 0,
        F.col("mean_difference") / (F.col("std") / F.sqrt(F.col("pairs").cast("double"))),
    )
    tied = (F.col("largest") > 1) | (F.col("nonzero") < F.col("pairs"))
    if method == "exact":
        exact = ~tied | (F.col("nonzero") <= exact_limit)
        possible = exact
    else:
        exact = ~tied & (F.col("nonzero") <= exact_limit) & F.lit(method == "auto")
        possible = F.lit(True)
    pvalue = rank_pvalue("w_plus", "nonzero", "ties", ~exact)
    if method == "exact":
        cells = F.when(tied & exact, F.col("cells"))
        pvalue = F.coalesce(tied_pvalue("w_plus", F.transform(cells, lambda c: c["rank"]), F.transform(cells, lambda c: c["count"])), F.when(~tied, pvalue))
    return joined.withColumn("t", t).select(
        *by, "pairs", "mean_difference", "t",
        t_pvalue(F.col("t"), (F.col("pairs") - 1).cast("double")).alias("paired_t_pvalue"),
        "w_plus", "w_minus",
        F.when(possible, pvalue).alias("wilcoxon_pvalue"),
        F.when(F.col("nonzero") > 0, F.when(exact, "exact").when(possible, "normal")).alias("wilcoxon_method"),
    )
