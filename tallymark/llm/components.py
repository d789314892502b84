"""Connected components of an edge table by alternating large and small stars (Kiveris et al.), all as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import forget, saved


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step: neighbours (larger ones or the others) of a node are linked to its smallest neighbour."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if large:
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        out = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        lower = both.filter("b < a")
        least = lower.groupBy("a").agg(F.min("b").alias("m"))
        out = lower.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
    return out.filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of `edges` (two columns of integers without nulls): the smallest node it is linked with.

    Loops and repeated edges do no harm; no edges give no rows. Each round is written to the shared folder, and rounds end when
    the edges no longer change. Nothing but two numbers a round reaches the driver.
    """
    a, b = edges.columns
    now = saved(edges.select(F.col(a).cast("bigint").alias("a"), F.col(b).cast("bigint").alias("b")).filter("a <> b").distinct(), "edges")
    state = None
    while True:
        known = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if known == state or not known[0]:
            break
        state = known
        before, now = now, saved(_star(_star(now, True), False), "edges")
        forget(before)
    roots = now.select("b").distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(roots.select(F.col("b").alias("id"), F.col("b").alias("component")))
