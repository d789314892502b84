"""Exact order statistics, hash-ordered cuts and running totals that never put a whole column,
class or group into one task.

* ``order_stats``: exact interpolated quantiles. A bounded sketch brackets every wanted rank, then
  only the values inside the brackets are counted, so next to nothing is shuffled.
* ``HashCuts``: the hash values at which a stratified random order reaches given ranks. Applying
  them is a narrow comparison, with no window over a class.
* ``CutTable``: the same for more classes than literals may hold, by joins.
* ``running_totals``: prefix sums over an ordered column in two levels.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window as W

from tallymark.functions.columns import hash_order, quoted
from tallymark.session import shared_dir

SMALL_ROWS = 20_000  # most rows a fitted table may have to be held by the driver and broadcast
SKETCH_ACCURACY = 10_000
WHOLE_ROWS = 20_000  # columns (or groups) up to this size are counted whole, without a bracket
BRACKET_ROWS = 2_000_000  # most values one bracket may hold before it is counted value by value
FEW_CLASSES = 1000  # most classes that literals may hold; more become a joined table
LEAF_ROWS = 200_000  # most rows that are ranked by one task
GRID = 500  # steps of the quantile grid that sampled brackets are read from
SAMPLE_ABOVE = 20_000_000  # from this size on brackets come from a sample, to keep sketches small
SAMPLE_ROWS = 1_000_000  # sampled values aimed at
PREFIX_DIGITS = 3  # hash digits that one refinement step looks at
BUCKET_ROWS = 1_000_000  # distinct values aimed at per bucket of a running total
MAX_BUCKETS = 20_000


def local_frame(spark: SparkSession, rows: Sequence[Mapping], schema: T.StructType) -> DataFrame:
    """A small driver-held table as a local relation."""
    table = pa.Table.from_pylist([dict(r) for r in rows], schema=to_arrow_schema(schema))
    return spark.createDataFrame(table, schema)


@dataclass(frozen=True)
class Settled:
    """A fitted table that has been computed: held by the driver if small, else checkpointed."""

    frame: DataFrame
    rows: list[dict] | None

    @property
    def small(self) -> bool:
        return self.rows is not None


def settle(df: DataFrame, bound: int = SMALL_ROWS) -> Settled:
    """Compute a fitted table once.

    Up to ``bound`` rows become a local table that may be broadcast. A larger one is checkpointed
    in the shared folder and has to be joined by shuffle.
    """
    table = df.limit(bound + 1).toArrow()
    if table.num_rows <= bound:
        return Settled(df.sparkSession.createDataFrame(table, df.schema), table.to_pylist())
    shared_dir(df.sparkSession)
    return Settled(df.checkpoint(eager=True), None)


def settle_wide(df: DataFrame) -> Settled:
    """``settle`` for a table that has a few rows a column by construction: no limit, so one job less."""
    table = df.toArrow()
    return Settled(df.sparkSession.createDataFrame(table, df.schema), table.to_pylist())


def _literal(value, kind: T.DataType) -> Column:
    if value is None:
        return F.lit(None).cast(kind)
    if isinstance(kind, T.ArrayType):
        return F.array(*[_literal(v, kind.elementType) for v in value])
    if isinstance(kind, T.StructType):
        return F.struct(*[_literal(value[f.name], f.dataType).alias(f.name) for f in kind])
    return F.lit(value).cast(kind)


def attach(df: DataFrame, fitted: Settled, by: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Give every row the fitted values ``cols`` of its group, null groups included.

    A whole-table fit becomes literals and a small table is broadcast. A large one is joined by
    shuffle, where the adaptive skew join splits hot groups.
    """
    if not by:
        kinds = {f.name: f.dataType for f in fitted.frame.schema}
        return df.select("*", *[_literal(fitted.rows[0][c], kinds[c]).alias(c) for c in cols])
    right = fitted.frame.select(*[F.col(b).alias(f"__by_{b}") for b in by], *cols)
    on = reduce(lambda a, b: a & b, [df[b].eqNullSafe(right[f"__by_{b}"]) for b in by])
    joined = df.join(F.broadcast(right) if fitted.small else right, on, "inner")
    return joined.drop(*[f"__by_{b}" for b in by])


# --------------------------------------------------------------------------- exact quantiles
# These plans hold a few expressions per wanted quantile, so they are written as SQL text: one
# round trip per expression.


def _number(value) -> str:
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    return f"{float(value)!r}D" if isinstance(value, float) else f"{value}L"


def _struct(n: str, below: str, inside: str, low: str, high: str) -> str:
    return (
        f"named_struct('n', bigint({n}), 'below', bigint({below}), 'inside', bigint({inside}), "
        f"'low', double({low}), 'high', double({high}))"
    )


def _grouped(df: DataFrame, by: Sequence[str], aggs: Sequence[str]) -> DataFrame:
    aggregates = [F.expr(a) for a in aggs]
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def _with_brackets(df: DataFrame, state: Settled, by: Sequence[str]):
    """Rows with their brackets in reach: as literals for a whole table, else by joining them.

    Returns the rows and a function from (bracket number, field) to SQL text.
    """
    if by:
        return attach(df, state, by, ["__br"]), lambda k, f: f"__br[{k}].{f}"
    brackets = state.rows[0]["__br"]
    return df, lambda k, f: _number(brackets[k][f])


def _sampled(df: DataFrame, share: float) -> tuple[DataFrame, str]:
    """The rows with one random number each, and the condition of being in the sample.

    A sample only places brackets; the counts that decide the result see every row.
    """
    if share >= 1.0:
        return df, "true"
    return df.withColumn("__r", F.rand(17)), f"__r < {share!r}D"


def _grid_step(prob: str, sampled: str, up: bool) -> str:
    """Grid position safely below (or above) a share, given how many values were sampled."""
    slack = f"(2 + ceil(3 * {GRID} / sqrt(greatest({sampled}, 1))))"
    return f"int(ceil({prob} * {GRID}) + {slack})" if up else f"int(floor({prob} * {GRID}) - {slack})"


def _first_brackets(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[Sequence[float]],
    by: Sequence[str],
    extras: Mapping[str, str],
    share: float,
    widen: int,
) -> DataFrame:
    """One pass: counts, extremes, the caller's extra aggregates and sketched brackets.

    ``widen`` counts earlier attempts; brackets grow tenfold with each.
    """
    rows, inside_sample = _sampled(df, share)
    slack = 3.0 / SKETCH_ACCURACY * 10**widen
    if share < 1.0:
        ends = [g / GRID for g in range(GRID + 1)]
    else:
        ends = None
    aggs, stats, brackets = [], [], []
    for i, c in enumerate(cols):
        around = ends or [p for q in probs[i] for p in (max(q - slack, 0.0), min(q + slack, 1.0))]
        points = "array(" + ", ".join(_number(float(e)) for e in around) + ")"
        x = f"double({quoted(c)})"
        held = x if share >= 1.0 else f"if({inside_sample}, {x}, NULL)"
        aggs += [f"count({x}) AS __n{i}", f"min({x}) AS __min{i}", f"max({x}) AS __max{i}"]
        if probs[i]:
            aggs.append(f"percentile_approx({held}, {points}, {SKETCH_ACCURACY}) AS __q{i}")
            aggs.append(f"count({held}) AS __m{i}")
        aggs += [f"{agg.format(x=x)} AS __x{i}_{name}" for name, agg in extras.items()]
        told = "".join(f", '{name}', __x{i}_{name}" for name in extras)
        stats.append(f"named_struct('count', __n{i}, 'min', __min{i}, 'max', __max{i}{told})")
        for j, q in enumerate(probs[i]):
            # the slack covers the sketch error and both neighbouring ranks from this size on
            whole = f"__n{i} <= {WHOLE_ROWS}"
            if share < 1.0:
                spread = f"(least(__m{i}, 1e15D) / {100**widen})"
                first = _grid_step(_number(float(q)), spread, up=False)
                last = _grid_step(_number(float(q)), spread, up=True)
                low = f"coalesce(if({whole} OR {first} <= 0, NULL, get(__q{i}, {first})), __min{i})"
                high = f"coalesce(if({whole} OR {last} >= {GRID}, NULL, get(__q{i}, {last})), __max{i})"
                share_inside = f"double({last} - {first}) / {GRID}"
            else:
                low = f"if({whole} OR {q - slack!r}D <= 0, __min{i}, __q{i}[{2 * j}])"
                high = f"if({whole} OR {q + slack!r}D >= 1, __max{i}, __q{i}[{2 * j + 1}])"
                share_inside = f"{4 * slack!r}D"
            guess = (
                f"if({low} = {high}, 1, if({whole}, __n{i}, "
                f"least(__n{i}, ceil(__n{i} * {share_inside}) + 2)))"
            )
            brackets.append(_struct(f"__n{i}", "0", guess, low, high))
    return _grouped(rows, by, aggs).select(
        *by,
        F.expr(f"array({', '.join(stats)}) AS __stats"),
        F.expr(f"array({', '.join(brackets)}) AS __br" if brackets else "NULL AS __br"),
    )


def _narrow(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[Sequence[float]],
    by: Sequence[str],
    state: Settled,
) -> DataFrame:
    """Shrink every bracket by one more pass."""
    rows, at = _with_brackets(df, state, by)
    rows, inside_sample = _sampled(rows, min(1.0, SAMPLE_ROWS / max(_fullest(state), 1)))
    grid = "array(" + ", ".join(_number(g / GRID) for g in range(GRID + 1)) + ")"
    aggs, brackets = [], []
    for k, (c, q) in enumerate((c, float(q)) for c, some in zip(cols, probs) for q in some):
        x = f"double({quoted(c)})"
        low, high = at(k, "low"), at(k, "high")
        within = f"{x} >= {low} AND {x} <= {high}"
        held = f"if({within} AND {inside_sample}, {x}, NULL)"
        aggs += [
            f"count(if({x} < {low}, 1, NULL)) AS __b{k}",
            f"count(if({within}, 1, NULL)) AS __i{k}",
            f"count({held}) AS __m{k}",
            f"percentile_approx({held}, {grid}, {SKETCH_ACCURACY}) AS __g{k}",
        ]
        old = f"__br[{k}]"
        rank = f"(bigint(floor(({old}.n - 1) * {_number(q)})) - __b{k})"
        first = _grid_step(f"(double({rank}) / greatest(__i{k}, 1))", f"__m{k}", up=False)
        last = _grid_step(f"(double({rank} + 2) / greatest(__i{k}, 1))", f"__m{k}", up=True)
        new_low = f"if({first} <= 0, {old}.low, coalesce(get(__g{k}, {first}), {old}.low))"
        new_high = f"if({last} >= {GRID}, {old}.high, coalesce(get(__g{k}, {last}), {old}.high))"
        guess = (
            f"if({new_low} = {new_high}, 1, "
            f"least(__i{k}, ceil(__i{k} * double({last} - {first}) / {GRID}) + 2))"
        )
        brackets.append(_struct(f"{old}.n", f"__b{k}", guess, new_low, new_high))
    counted = attach(_grouped(rows, by, aggs), state, by, ["__stats", "__br"])
    return counted.select(*by, "__stats", F.expr(f"array({', '.join(brackets)}) AS __br"))


def _count_whole(
    df: DataFrame, cols: Sequence[str], probs: Sequence[Sequence[float]], by: Sequence[str]
) -> DataFrame:
    """The quantiles by the built-in aggregate, for groups known to be of ``WHOLE_ROWS`` at most."""
    wanted = ["array(" + ", ".join(_number(float(p)) for p in some) + ")" for some in probs]
    wide = _grouped(
        df, by, [f"percentile(double({quoted(c)}), {wanted[i]}) AS __q{i}" for i, c in enumerate(cols)]
    )
    places = [(i, j) for i in range(len(cols)) for j in range(len(probs[i]))]
    listed = ", ".join(f"named_struct('k', {k}, 'value', __q{i}[{j}])" for k, (i, j) in enumerate(places))
    return wide.selectExpr(*map(quoted, by), f"inline(array({listed}))").filter("value IS NOT NULL")


def _count_brackets(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[Sequence[float]],
    by: Sequence[str],
    state: Settled,
) -> DataFrame:
    """Read the wanted ranks off the counted values inside the brackets."""
    rows, at = _with_brackets(df, state, by)
    within, below, held, places = [], [], [], []
    for k, c in enumerate(c for c, some in zip(cols, probs) for _ in some):
        x = f"double({quoted(c)})"
        n, low, high = at(k, "n"), at(k, "low"), at(k, "high")
        # rows of a bracket that holds one value are counted without being listed
        inside = f"({x} >= {low} AND {x} <= {high} AND {low} < {high})"
        within.append(inside)
        held.append(f"if({inside}, named_struct('k', {k}, 'n', {n}, 'v', {x}), NULL)")
        below.append(f"count(if({x} < {low}, 1, NULL)) AS __b{k}")
        below.append(f"count(if({x} = {low} AND {low} = {high}, 1, NULL)) AS __e{k}")
        b = f"__br[{k}]"
        places.append(f"named_struct('k', {k}, 'n', {b}.n, 'v', double(NULL), 'count', __b{k})")
        places.append(f"named_struct('k', {k}, 'n', {b}.n, 'v', {b}.low, 'count', __e{k})")
    members = (
        rows.filter(" OR ".join(within))
        .selectExpr(*map(quoted, by), f"explode(array({', '.join(held)})) AS p")
        .filter("p is not null")
        .groupBy(*by, "p.k", "p.n", "p.v")
        .count()
    )
    under = (
        attach(_grouped(rows, by, below), state, by, ["__br"])
        .selectExpr(*map(quoted, by), f"explode(array({', '.join(places)})) AS p")
        .select(*by, "p.*")
        .filter("count > 0")
    )
    cells = members.unionByName(under)  # a missing value stands for everything below the bracket
    order = W.partitionBy(*by, "k").orderBy(F.col("v").asc_nulls_first())
    cells = cells.withColumn(
        "upto", F.sum("count").over(order.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    wanted = "array(" + ", ".join(_number(float(p)) for some in probs for p in some) + ")"
    picked = (
        cells.withColumn("pos", F.expr(f"(n - 1) * get({wanted}, k)"))
        .withColumn("rank", F.expr("bigint(floor(pos))"))
        .withColumn("following", F.expr("least(rank + 1, n - 1)"))
        .groupBy(*by, "k")
        .agg(
            F.expr("max(if(upto - count <= rank AND upto > rank, v, NULL)) AS a"),
            F.expr("max(if(upto - count <= following AND upto > following, v, NULL)) AS b"),
            F.expr("max(pos - rank) AS part"),
        )
    )
    return picked.selectExpr(*map(quoted, by), "k", "a + (b - a) * part AS value")


def order_stats(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    extras: Mapping[str, str] | None = None,
) -> DataFrame:
    """Exact interpolated quantiles with count, min, max and extra aggregates.

    One row per group and column: ``by…, column, count, min, max, <extras…>, quantiles`` where
    ``quantiles`` follows ``probs``; an extra aggregate is SQL text over ``{x}``. Missing values
    are left out. Three scans of the needed columns at ordinary sizes, one more per further factor
    of about sixty beyond a hundred million rows.
    """
    cols, probs, by = list(cols), list(probs), list(by)
    extras = dict(extras or {})
    state, found = _fit_quantiles(df, cols, probs, by, extras)
    names = "array(" + ", ".join("'" + c.replace("'", "\\'") + "'" for c in cols) + ")"
    listed = (
        state.frame.select(*by, F.posexplode("__stats").alias("__i", "s"))
        .select(*by, "__i", F.expr(f"get({names}, __i)").alias("column"), "s.*")
    )
    if not probs:
        return listed.drop("__i")
    if state.small and found.small:
        spark = df.sparkSession
        values = {(*[r[b] for b in by], r["k"]): r["value"] for r in found.rows}
        rows = [
            {
                **{b: r[b] for b in by},
                "column": c,
                **r["__stats"][i],
                "quantiles": [
                    values.get((*[r[b] for b in by], i * len(probs) + j)) for j in range(len(probs))
                ],
            }
            for r in state.rows
            for i, c in enumerate(cols)
        ]
        schema = T.StructType(
            [f for f in listed.schema.fields if f.name != "__i"]
            + [T.StructField("quantiles", T.ArrayType(T.DoubleType()))]
        )
        return local_frame(spark, rows, schema)
    parts = ", ".join(f"max(if(k % {len(probs)} = {j}, value, NULL))" for j in range(len(probs)))
    per_column = (
        found.frame.groupBy(*by, F.expr("int(floor(k / %d))" % len(probs)).alias("__j"))
        .agg(F.expr(f"array({parts})").alias("quantiles"))
        .select(*[F.col(b).alias(f"__by_{b}") for b in by], "__j", "quantiles")
    )
    on = [listed[b].eqNullSafe(per_column[f"__by_{b}"]) for b in by]
    on.append(listed["__i"] == per_column["__j"])
    joined = listed.join(per_column, reduce(lambda a, b: a & b, on), "left")
    return joined.drop("__i", "__j", *[f"__by_{b}" for b in by])


def _no_nan(df: DataFrame, c: str) -> Column:
    """The column with NaN as missing."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(quoted(c)), F.lit(None)).alias(c)
    return F.col(quoted(c))


def _fit_quantiles(
    df, cols, probs, by, extras, stats: bool = True, rows: int | None = None
) -> tuple[Settled | None, Settled | None]:
    """Statistics and quantiles; without ``stats`` a small table is read for its quantiles alone.

    ``probs`` are shared by the columns, or one list of the same length for each. ``rows``, where the
    caller knows it, saves the pass that counts.
    """
    shared = not probs or not isinstance(probs[0], Sequence)
    probs = [list(probs)] * len(cols) if shared else [list(p) for p in probs]
    base = df.select(*by, *[_no_nan(df, c) for c in dict.fromkeys(cols) if c not in by])
    keep = settle if by else settle_wide
    if not any(probs):
        return keep(_first_brackets(base, cols, probs, by, extras, 1.0, 0)), None
    rows = base.count() if rows is None else rows
    if not stats and not by and rows <= WHOLE_ROWS:
        return None, keep(_count_whole(base, cols, probs, by))
    share = 1.0 if rows <= SAMPLE_ABOVE else SAMPLE_ROWS / rows
    for widen in range(5):
        state = keep(_first_brackets(base, cols, probs, by, extras, share, widen))
        if state.small and all(s["count"] <= WHOLE_ROWS for r in state.rows for s in r["__stats"]):
            return state, keep(_count_whole(base, cols, probs, by))
        for _ in range(6):
            if _fullest(state) <= BRACKET_ROWS:
                break
            state = keep(_narrow(base, cols, probs, by, state))
        found = keep(_count_brackets(base, cols, probs, by, state))
        if not _missed(state, found, len(probs[0])):
            return state, found
    raise RuntimeError("a quantile lies outside its bracket")


def _missed(state: Settled, found: Settled, wanted: int) -> bool:
    """Whether a wanted rank was not among the values of its bracket."""
    if state.small and found.small:
        held = sum(s["count"] > 0 for r in state.rows for s in r["__stats"])
        return sum(r["value"] is not None for r in found.rows) < held * wanted
    return not found.frame.filter("value IS NULL").isEmpty()


def _fullest(state: Settled) -> int:
    """Values in the fullest bracket."""
    if state.small:
        return max((s["inside"] or 0 for r in state.rows for s in r["__br"]), default=0)
    return state.frame.agg(F.expr("max(array_max(transform(__br, s -> s.inside)))")).first()[0] or 0


def quantile_values(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float] | Sequence[Sequence[float]],
    rows: int | None = None,
) -> dict[str, list[float | None]]:
    """Exact quantiles of whole columns on the driver: one short list per column.

    ``probs`` are shared by all columns, or one list of the same length per column.
    """
    _, found = _fit_quantiles(df, list(cols), list(probs), [], {}, stats=False, rows=rows)
    width = len(probs[0]) if probs and isinstance(probs[0], Sequence) else len(probs)
    out = {c: [None] * width for c in cols}
    for r in found.rows:
        out[cols[r["k"] // width]][r["k"] % width] = r["value"]
    return out


# --------------------------------------------------------------------------- hash-ordered cuts


@dataclass(frozen=True)
class HashCuts:
    """Per class, the hash values at which its random order reaches the wanted ranks."""

    y: str | None
    key: tuple[str, ...]
    seed: int
    cuts: dict  # class -> list of hash values, ascending ("" for rank 0)

    def mark(self, df: DataFrame, out: str) -> DataFrame:
        """Add how many cuts of its class a row lies behind: 0 for the first block.

        The hash is a column of its own first, so it is computed once per row.
        """
        count = lambda cuts: " + ".join(["0", *[f"int(__h > '{c}')" for c in cuts]])
        if self.y is None:
            step = F.expr(count(self.cuts[None]))
        else:
            step = F.lit(None).cast("int")
            for label, cuts in self.cuts.items():
                same = F.col(self.y).eqNullSafe(F.lit(label))
                step = F.when(same, F.expr(count(cuts))).otherwise(step)
        hashed = df.withColumn("__h", hash_order(self.key, self.seed))
        return hashed.withColumn(out, step).drop("__h")


def few_class_counts(df: DataFrame, y: str) -> dict | None:
    """Rows per class on the driver, or None for more than ``FEW_CLASSES`` classes."""
    rows = df.groupBy(y).count().limit(FEW_CLASSES + 1).collect()
    if len(rows) > FEW_CLASSES:
        return None
    return {r[0]: r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0]))}


def class_table(df: DataFrame, y: str) -> DataFrame:
    """``c, n``: every class, null included, with its rows, for classes of any number."""
    shared_dir(df.sparkSession)
    return df.groupBy(F.col(quoted(y)).alias("c")).agg(F.count(F.lit(1)).alias("n")).checkpoint()


def class_counts(df: DataFrame, y: str | None, most: int = 1000) -> dict:
    """Rows per class on the driver, for models whose work grows with the classes. More than ``most``
    is an error in the choice of the label column."""
    if y is None:
        return {None: df.count()}
    rows = df.groupBy(y).count().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{y!r} has more than {most} values and is not a class label")
    return {r[0]: r[1] for r in sorted(rows, key=lambda r: (r[0] is not None, r[0]))}


def fit_cuts(
    df: DataFrame,
    y: str | None,
    key: str | Sequence[str],
    seed: int,
    ranks: Mapping[object, Sequence[int]],
    sizes: Mapping[object, int],
) -> HashCuts:
    """Find the hash value of each wanted 1-based rank inside its class.

    A class is never ordered as a whole: hash prefixes are counted, only the prefix that holds
    the wanted rank is looked into further, and the last short stretch is ranked.
    """
    spark: SparkSession = df.sparkSession
    keys = (key,) if isinstance(key, str) else tuple(key)
    hashed = df.select(
        (F.col(y) if y is not None else F.lit(0)).alias("c"), hash_order(keys, seed).alias("h")
    )
    label_type = hashed.schema["c"].dataType
    found: dict[tuple, str] = {}
    open_: list[tuple] = []  # class, position, prefix, rank inside the prefix, rows of the prefix
    for label, wanted in ranks.items():
        for i, rank in enumerate(wanted):
            if rank <= 0:
                found[(label, i)] = ""
            elif rank >= sizes[label]:
                found[(label, i)] = "g"  # behind every hex digit
            else:
                open_.append((label if y is not None else 0, i, "", int(rank), sizes[label]))
    schema = T.StructType(
        [
            T.StructField("w", label_type),
            T.StructField("i", T.IntegerType()),
            T.StructField("prefix", T.StringType()),
            T.StructField("rank", T.LongType()),
            T.StructField("rows", T.LongType()),
        ]
    )
    length = 0
    while open_ and max(r[4] for r in open_) > LEAF_ROWS and length + PREFIX_DIGITS <= 30:
        wanted_df = local_frame(spark, [dict(zip(schema.names, r)) for r in open_], schema)
        counted = (
            _inside(hashed, wanted_df.select("w", "prefix").distinct(), length)
            .groupBy("c", F.substring("h", 1, length + PREFIX_DIGITS).alias("next"))
            .count()
            .withColumn("start", F.substring("next", 1, length))
        )
        upto = F.sum("count").over(
            W.partitionBy("c", "start").orderBy("next").rowsBetween(
                W.unboundedPreceding, W.currentRow
            )
        )
        ranked = counted.withColumn("upto", upto)
        hit = (
            F.col("c").eqNullSafe(F.col("w"))
            & (F.col("start") == F.col("prefix"))
            & (F.col("upto") >= F.col("rank"))
            & (F.col("upto") - F.col("count") < F.col("rank"))
        )
        open_ = [
            tuple(r)
            for r in ranked.join(F.broadcast(wanted_df), hit)
            .select("w", "i", "next", F.col("rank") - F.col("upto") + F.col("count"), "count")
            .collect()
        ]
        length += PREFIX_DIGITS
    if open_:
        wanted_df = local_frame(spark, [dict(zip(schema.names, r)) for r in open_], schema)
        # equal hashes (rows that share a key) count as one step, so they stay on one side of a cut
        stretch = (
            _inside(hashed, wanted_df.select("w", "prefix").distinct(), length)
            .groupBy("c", F.substring("h", 1, length).alias("start"), "h")
            .count()
        )
        upto = F.sum("count").over(
            W.partitionBy("c", "start").orderBy("h").rowsBetween(W.unboundedPreceding, W.currentRow)
        )
        hit = (
            F.col("c").eqNullSafe(F.col("w"))
            & (F.col("start") == F.col("prefix"))
            & (F.col("upto") >= F.col("rank"))
            & (F.col("upto") - F.col("count") < F.col("rank"))
        )
        for r in (
            stretch.withColumn("upto", upto)
            .join(F.broadcast(wanted_df), hit)
            .select("w", "i", "h")
            .collect()
        ):
            found[(r["w"] if y is not None else None, r["i"])] = r["h"]
    cuts = {
        label: [found[(label, i)] for i in range(len(wanted))] for label, wanted in ranks.items()
    }
    return HashCuts(y, keys, seed, cuts)


@dataclass(frozen=True)
class CutTable:
    """``HashCuts`` for any number of classes: a table of ``c, cuts`` and whatever else a class was given."""

    y: str
    key: tuple[str, ...]
    seed: int
    fitted: Settled

    def mark(self, df: DataFrame, out: str, told: Sequence[str] = ()) -> DataFrame:
        """Add how many cuts of its class a row lies behind, and the columns ``told`` of its class."""
        cuts = Settled(self.fitted.frame.withColumnRenamed("c", self.y), self.fitted.rows)
        hashed = attach(df.withColumn("__h", hash_order(self.key, self.seed)), cuts, [self.y], ["__cuts", *told])
        return hashed.withColumn(out, F.expr("size(filter(__cuts, e -> __h > e))")).drop("__h", "__cuts")


def fit_cut_table(
    df: DataFrame, y: str, key: str | Sequence[str], seed: int, classes: DataFrame, ranks: Column, told: Sequence[str] = ()
) -> CutTable:
    """``fit_cuts`` where the classes do not fit the driver.

    ``classes`` holds ``c, n`` and what ``ranks`` (an array of 1-based ranks) and ``told`` need. Hash prefixes are counted as there, but
    all wanted ranks stay a table: a hot class is split by its prefixes before any join, and a window sees either the prefixes of one
    stretch or the hashes of one short stretch.
    """
    keys = (key,) if isinstance(key, str) else tuple(key)
    hashed = df.select(F.col(quoted(y)).alias("c"), hash_order(keys, seed).alias("h"))
    wanted = classes.select("c", "n", F.posexplode(ranks).alias("i", "rank")).select(
        F.col("c").alias("w"), "i", F.col("rank").cast("bigint").alias("rank"), F.lit("").alias("prefix"), F.col("n").alias("rows")
    )
    outer = wanted.select(
        "w", "i", F.expr("CASE WHEN rank <= 0 THEN '' WHEN rank >= rows THEN 'g' END").alias("h")  # 'g' is behind every hex digit
    ).filter("h IS NOT NULL")
    open_ = wanted.filter("rank > 0 AND rank < rows").checkpoint()
    length = 0

    def reached(cells: DataFrame, value: str) -> DataFrame:
        """The cell of its class and stretch at which each open rank is reached."""
        upto = F.sum("count").over(W.partitionBy("c", "start").orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow))
        hit = F.col("c").eqNullSafe(F.col("w")) & (F.col("start") == F.col("prefix"))
        return cells.withColumn("upto", upto).join(open_, hit).filter("upto >= rank AND upto - count < rank")

    def rows_of(table: DataFrame) -> DataFrame:
        if not length:  # every class has an open rank or is small
            return table
        on = F.col("c").eqNullSafe(F.col("w")) & (F.substring("h", 1, length) == F.col("prefix"))
        return table.join(open_.select("w", "prefix").distinct(), on, "left_semi")

    while length + PREFIX_DIGITS <= 30 and (open_.agg(F.max("rows")).first()[0] or 0) > LEAF_ROWS:
        counted = rows_of(hashed).groupBy("c", F.substring("h", 1, length + PREFIX_DIGITS).alias("next")).count()
        cells = counted.withColumn("start", F.substring("next", 1, length))
        open_ = reached(cells, "next").select(
            "w", "i", (F.col("rank") - F.col("upto") + F.col("count")).alias("rank"), F.col("next").alias("prefix"), F.col("count").alias("rows")
        ).checkpoint()
        length += PREFIX_DIGITS
    stretch = rows_of(hashed).groupBy("c", F.substring("h", 1, length).alias("start"), "h").count()
    cuts = outer.unionByName(reached(stretch, "h").select("w", "i", "h"))
    listed = cuts.groupBy("w").agg(F.sort_array(F.collect_list("h")).alias("__cuts"))
    on = F.col("c").eqNullSafe(F.col("w"))
    return CutTable(y, keys, seed, settle(classes.join(listed, on).select("c", "__cuts", *told), SMALL_ROWS))


def numbered(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """Gapless numbers from 1 in a global order: sorted stretches are numbered by themselves and moved by the rows before them.

    Rows that ``order`` does not tell apart get any of their numbers.
    """
    shared_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).withColumn("__at", F.spark_partition_id()).checkpoint()
    sizes = ranged.groupBy("__at").count()
    before = W.orderBy("__at").rowsBetween(W.unboundedPreceding, -1)  # one row a partition
    starts = settle(sizes.select("__at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start")))
    own = F.row_number().over(W.partitionBy("__at").orderBy(*order))
    return attach(ranged.withColumn(out, own), starts, ["__at"], ["__start"]).withColumn(out, F.col(out) + F.col("__start")).drop("__at", "__start")


def _inside(hashed: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """Rows whose class and hash prefix hold a wanted rank (at most classes x cuts prefixes)."""
    on = F.col("c").eqNullSafe(F.col("w"))
    if length:
        on = on & (F.substring("h", 1, length) == F.col("prefix"))
    return hashed.join(F.broadcast(wanted), on, "left_semi")


def split_evenly(size: int, parts: int) -> list[int]:
    """Ranks at which ``parts`` blocks end whose sizes differ by at most one, larger ones first."""
    ends, end = [], 0
    for i in range(parts):
        end += size // parts + (1 if i < size % parts else 0)
        ends.append(end)
    return ends


# --------------------------------------------------------------------------- running totals


def running_totals(
    cells: DataFrame,
    order: str,
    measures: Sequence[str],
    by: Sequence[str] = (),
    ascending: bool = True,
    rows: int | None = None,
) -> DataFrame:
    """Inclusive prefix sums ``cum_<measure>`` of already grouped cells along ``order``.

    Few cells are summed in one window per group. Beyond that the order column is cut into value
    ranges; range totals are summed first, so each task sums one range of bounded size.
    """
    by = list(by)
    n = cells.count() if rows is None else rows

    def frame(w):
        sort = F.col(order).asc() if ascending else F.col(order).desc()
        return w.orderBy(sort).rowsBetween(W.unboundedPreceding, W.currentRow)

    if n <= BUCKET_ROWS:  # n bounds the cells of all groups together
        return cells.select(
            "*", *[F.sum(m).over(frame(W.partitionBy(*by))).alias(f"cum_{m}") for m in measures]
        )
    shared_dir(cells.sparkSession)
    cells = cells.checkpoint()  # read three times below
    buckets = min(max(2, -(-n // BUCKET_ROWS) * 2), MAX_BUCKETS)
    probs = [i / buckets for i in range(1, buckets)]
    sample = cells.sample(min(1.0, 100.0 * buckets / n), seed=17)  # ranges need to be even, not exact
    inner = sample.agg(
        F.percentile_approx(F.col(order).cast("double"), probs, 10 * buckets)
    ).first()[0] or [0.0]
    splits = [float("-inf"), *sorted(set(inner)), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="__o", outputCol="__b", handleInvalid="keep")
    ranged = cut.transform(cells.withColumn("__o", F.col(order).cast("double"))).drop("__o")
    totals = ranged.groupBy(*by, "__b").agg(*[F.sum(m).alias(f"__t_{m}") for m in measures])
    sort = F.col("__b").asc() if ascending else F.col("__b").desc()
    earlier = W.partitionBy(*by).orderBy(sort).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "__b",
        *[F.coalesce(F.sum(f"__t_{m}").over(earlier), F.lit(0)).alias(f"__p_{m}") for m in measures],
    )
    joined = attach(ranged, settle(offsets), [*by, "__b"], [f"__p_{m}" for m in measures])
    local = frame(W.partitionBy(*by, "__b"))
    out = joined.select(
        *cells.columns,
        *[(F.sum(m).over(local) + F.col(f"__p_{m}")).alias(f"cum_{m}") for m in measures],
    )
    return out


def most_frequent(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent value per column, the smallest one on ties: ``by…, column, value, count``.

    Values are counted first, so a column with many distinct values is never held by one task. Columns
    of different types are counted in their own types; their ``value`` is a double if all are numbers,
    else text.
    """
    kinds: dict[T.DataType, list[str]] = {}
    for c in cols:
        kinds.setdefault(df.schema[c].dataType, []).append(c)
    if len(kinds) > 1:
        numbers = all(isinstance(k, T.NumericType) for k in kinds)
        parts = [most_frequent(df, some, by) for some in kinds.values()]
        shown = [p.withColumn("value", F.col("value").cast("double" if numbers else "string")) for p in parts]
        return reduce(DataFrame.unionByName, shown)
    (cast,) = kinds
    long = df.select(
        *by,
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(c).cast(cast).alias("value"))
                    for c in cols
                ]
            )
        ).alias("p"),
    ).select(*by, "p.*")
    counted = long.filter(F.col("value").isNotNull()).groupBy(*by, "column", "value").count()
    return counted.groupBy(*by, "column").agg(
        F.min_by("value", F.struct(-F.col("count"), F.col("value"))).alias("value"),
        F.max("count").alias("count"),
    )


def top_k(df: DataFrame, k: int, by: Sequence[str], ascending: bool = False) -> DataFrame:
    """The k rows with the largest (or smallest) values of ``by``, nulls last; one bounded merge, no full sort."""
    if k < 0:
        raise ValueError("k is negative")
    order = [F.asc_nulls_last(quoted(c)) if ascending else F.desc_nulls_last(quoted(c)) for c in by]
    return df.orderBy(*order).limit(k)


def head(df: DataFrame, n: int, order_by: Sequence[str]) -> DataFrame:
    """The first n rows in the order of ``order_by``: rows have no order of their own."""
    return top_k(df, n, order_by, ascending=True)


def outer_align(frames: Mapping[str, DataFrame], on: Sequence[str], value: str) -> DataFrame:
    """``value`` of several frames side by side for every key that any of them has: ``on…, <one column per name>``.

    Keys are unique within a frame (else the largest value counts); a null key matches a null key. All
    frames meet in one shuffle.
    """
    parts = [
        f.select(*[F.col(quoted(c)) for c in on], F.lit(i).alias("__i"), F.col(quoted(value)).alias("__value"))
        for i, f in enumerate(frames.values())
    ]
    cells = [F.max(F.when(F.col("__i") == i, F.col("__value"))).alias(n) for i, n in enumerate(frames)]
    return reduce(DataFrame.unionByName, parts).groupBy(*on).agg(*cells)


def sample_rows(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """A reproducible random sample of n rows: the n lowest hashes, found without a sort."""
    total = df.count()
    if n >= total:
        return df
    cuts = fit_cuts(df, None, key, seed, {None: [n]}, {None: total})
    return cuts.mark(df, "__step").filter("__step = 0").drop("__step")
