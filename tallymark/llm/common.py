"""What several operators of this subpackage share: the shared folder, broadcasts, gapless numbers."""

from __future__ import annotations

from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.session import delete_path, scratch_path

#: Rows of a side that may be broadcast once they have been counted; more are joined by shuffle.
BROADCAST_ROWS = 100_000
#: Copies of one row that are written out from one generated row.
COPIES = 4096
#: Spark's setting that removes the shuffle files of a query once it has ended.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read back: lineage ends there, and a lost executor loses none of it.

    What was shuffled for it is of no more use once it is written, so those files go at once and don't fill the disks until the driver
    collects its garbage.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


_shared: list[Broadcast] = []


def share(spark: SparkSession, value) -> Broadcast:
    """A broadcast that `unshare` takes from the executors once the results that use it were written."""
    _shared.append(spark.sparkContext.broadcast(value))
    return _shared[-1]


def unshare() -> int:
    """Take all broadcasts of `share` from the executors; a plan that still uses one fetches it from the driver again."""
    n = len(_shared)
    while _shared:
        _shared.pop().unpersist()
    return n


def forget(*tables: DataFrame) -> None:
    """Delete tables that `saved` wrote, once all that was made from them is saved too."""
    for df in tables:
        path = _paths.pop(df, None)
        if path is not None:
            delete_path(df.sparkSession, path)


def joined_small(df: DataFrame, side: DataFrame, on: Sequence[str], how: str = "left", rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join with `side`, broadcast if a count shows at most `rows` rows, else by shuffle (the adaptive join splits hot keys)."""
    small = side.limit(rows + 1).count() <= rows
    return df.join(F.broadcast(side) if small else side, list(on), how)


def fresh(name: str, taken: Sequence[str]) -> str:
    """`name`, or with underscores before it until no column has that name (column names ignore case)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


def set_aside(df: DataFrame, results: Sequence[str]) -> tuple[DataFrame, dict[str, str]]:
    """`df` with its columns that are named like `results` under other names, and the name that each of its columns has now."""
    taken, now = {c.lower() for c in results}, {}
    for c in df.columns:
        now[c] = fresh(f"own_{c}", [*df.columns, *results, *now.values()]) if c.lower() in taken else c
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in now.items()]), now


def spread(*cols: Column) -> Column:
    """A block of three hexadecimal digits (4096 blocks) that a row's values alone decide; SQL engines agree on it."""
    text = F.concat_ws("|", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.substring(F.md5(text), 1, 3)


def numbered(df: DataFrame, by: str, order: Sequence[str], out: str) -> DataFrame:
    """Each row with its gapless number from 0 among the rows of its `by` value, in the order of (block, `order`).

    `by` holds no nulls and few values. No value's rows meet in one task: equal rows are counted first, each block of
    `spread` is numbered by itself, and the blocks' first numbers come from their counts (4096 rows for each `by` value).
    """
    block, copies, first, before = (fresh(c, df.columns) for c in ("block", "copies", "first", "before"))
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies)).withColumn(block, spread(*[F.col(c) for c in order[:1]]))
    earlier = Window.partitionBy(by).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(by, block).agg(F.sum(copies).alias(before)).select(
        by, block, F.coalesce(F.sum(before).over(earlier), F.lit(0)).alias(first)
    )
    inside = Window.partitionBy(by, block).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.join(starts, [by, block]).withColumn(before, F.col(first) + F.coalesce(F.sum(copies).over(inside), F.lit(0)))
    return repeated(placed, copies, before, out).drop(copies, before, block, first).select(*df.columns, out)


def repeated(df: DataFrame, copies: str, first: str, out: str) -> DataFrame:
    """Each row as often as `copies` says, `out` counting on from `first`; long runs are generated in pieces."""
    piece = fresh("piece", df.columns)
    pieces = F.explode(F.expr(f"sequence(0L, (`{copies}` - 1) div {COPIES})"))
    each = F.explode(F.expr(f"sequence(`{first}` + `{piece}` * {COPIES}, `{first}` + least(`{copies}`, (`{piece}` + 1) * {COPIES}) - 1)"))
    return df.withColumn(piece, pieces).withColumn(out, each).drop(piece)
