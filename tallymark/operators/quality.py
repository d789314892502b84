"""Data-quality reports. Each is one pass, or one shuffle of counts already combined map-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.functions.columns import quoted, safe_ratio

COPIES_PER_TASK_STEP = 100_000


def percent(part: Column, whole: Column, decimals: int | None) -> Column:
    value = F.coalesce(safe_ratio(part * F.lit(100.0), whole), F.lit(0.0))
    return value if decimals is None else F.round(value, decimals)


def null_profile(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    only_positive: bool = True,
    decimals: int | None = None,
) -> DataFrame:
    """Missing values per column: ``column, nulls, pct``, the emptiest first."""
    cols = list(cols or df.columns)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(quoted(c))).alias(f"c{i}") for i, c in enumerate(cols)]
    )
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), (F.col("n") - F.col(f"c{i}")).alias("nulls"))
            for i, c in enumerate(cols)
        ]
    )
    long = counts.select("n", F.explode(cells).alias("p")).select(
        "p.column", "p.nulls", percent(F.col("p.nulls"), F.col("n"), decimals).alias("pct")
    )
    if only_positive:
        long = long.filter(F.col("nulls") > 0)
    return long.orderBy(F.desc("pct"), "column")


def frame_info(df: DataFrame) -> DataFrame:
    """Per column: position, type, non-null count, rows of the table."""
    cells = F.array(
        *[
            F.struct(
                F.lit(i).cast("bigint").alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                F.col(f"c{i}").alias("non_null"),
            )
            for i, f in enumerate(df.schema)
        ]
    )
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)],
    )
    return counts.select("n", F.explode(cells).alias("p")).select(
        "p.*", F.col("n").alias("row_count")
    )


def row_groups(df: DataFrame, cols: Sequence[str] | None = None, digest: bool = False) -> DataFrame:
    """Distinct rows with their number of copies, ``copies``.

    Copies collapse before the shuffle, so a row that makes up a third of the table costs no more
    than any other. ``digest`` replaces long texts by their SHA-256 when only counts matter.
    """
    cols = list(cols or df.columns)
    kinds = dict(df.dtypes)
    keys = [
        F.sha2(F.col(c), 256).alias(c) if digest and kinds[c] == "string" else F.col(c)
        for c in cols
    ]
    return df.select(*keys).groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))


def duplicate_summary(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    decimals: int | None = None,
    digest: bool = False,
) -> DataFrame:
    """Rows, rows that repeat an earlier one, and their percentage."""
    totals = row_groups(df, cols, digest).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
    )
    return totals.select(
        "row_count", "duplicates", percent(F.col("duplicates"), F.col("row_count"), decimals).alias("pct")
    )


def duplicate_rows(
    df: DataFrame, cols: Sequence[str] | None = None, limit: int | None = 5
) -> DataFrame:
    """Every member of every group of identical rows, ordered by all columns.

    The members of a group are equal, so they are written out from its count. With a limit only
    that many groups are needed; without one a large group is written out by many tasks.
    """
    cols = list(cols or df.columns)
    groups = row_groups(df, cols).filter(F.col("copies") > 1)
    if limit is not None:
        first = groups.orderBy(*cols).limit(limit)
        copies = F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(limit)))
        return first.select(*cols, F.explode(copies)).select(*cols).orderBy(*cols).limit(limit)
    step = COPIES_PER_TASK_STEP
    chunks = groups.select(
        *cols,
        F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / step))).alias("__chunk"),
        "copies",
    ).repartition(*cols, "__chunk")
    left = F.least(F.col("copies") - F.col("__chunk") * step, F.lit(step))
    return chunks.select(*cols, F.explode(F.sequence(F.lit(1), left))).select(*cols)


def quality_summary(df: DataFrame, target: str, decimals: int | None = 2) -> DataFrame:
    """``metric, count, percentage`` for missing targets and exact duplicate rows, in one pass."""
    totals = row_groups(df).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col(target).isNull(), F.col("copies"))), F.lit(0)).alias("a"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("b"),
    )
    cells = F.array(
        F.struct(F.lit("Missing target").alias("metric"), F.col("a").alias("count")),
        F.struct(F.lit("Exact duplicate rows").alias("metric"), F.col("b").alias("count")),
    )
    return totals.select("n", F.explode(cells).alias("p")).select(
        "p.metric", "p.count", percent(F.col("p.count"), F.col("n"), decimals).alias("percentage")
    )


def class_balance(df: DataFrame, c: str, decimals: int | None = None) -> DataFrame:
    """Rows and share per value of a column, missing values left out."""
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    share = safe_ratio(F.col("n"), total)
    return counts.select(c, "n", (share if decimals is None else F.round(share, decimals)).alias("share"))


def validate(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Check named row conditions (true means fine; a missing value passes).

    Returns the violations per rule, the valid rows, and the quarantined rows with the names of
    the broken rules.
    """
    names = list(rules)
    broken = {name: ~F.coalesce(rule, F.lit(True)) for name, rule in rules.items()}
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(F.when(broken[name], 1)).alias(f"c{i}") for i, name in enumerate(names)],
    )
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.col(f"c{i}").alias("violations"))
            for i, name in enumerate(names)
        ]
    )
    report = counts.select("n", F.explode(cells).alias("p")).select(
        "p.rule", "p.violations", percent(F.col("p.violations"), F.col("n"), None).alias("pct")
    )
    marked = df.withColumn(
        "broken_rules",
        F.array_compact(F.array(*[F.when(broken[name], F.lit(name)) for name in names])),
    )
    valid = marked.filter(F.size("broken_rules") == 0).drop("broken_rules")
    return report, valid, marked.filter(F.size("broken_rules") > 0)
