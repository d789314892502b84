"""Column expressions. All of them stay on the JVM side."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of the numeric columns, in table order."""
    skip = set(exclude)
    return [
        f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def case_when(branches: Sequence[tuple[Column, Any]], default: Any = None) -> Column:
    """First branch whose condition holds, else the default."""
    (condition, value), *rest = branches
    out = F.when(condition, value)
    for condition, value in rest:
        out = out.when(condition, value)
    return out.otherwise(default)


def map_values(c: str | Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Dictionary lookup; keys that are not listed (and null) give the default."""
    column = as_column(c)
    return case_when([(column == key, F.lit(value)) for key, value in mapping.items()], default)


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / den as double; a zero or missing denominator gives null."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def guarded(num: Column, den: Column) -> Column:
    """num / den where an empty denominator counts as 0.0."""
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def cut(
    c: str | Column,
    edges: Sequence[float],
    labels: Sequence[str],
    include_lowest: bool = True,
) -> Column:
    """Label of the right-closed interval (edge, next edge]; outside every interval: null."""
    if len(labels) != len(edges) - 1:
        raise ValueError("cut needs one label per interval")
    column = as_column(c)
    branches = []
    for i, label in enumerate(labels):
        low, high = edges[i], edges[i + 1]
        above = column >= low if i == 0 and include_lowest else column > low
        branches.append((above & (column <= high), F.lit(label)))
    return case_when(branches)


def outcome_type(y: str | Column, prediction: str | Column) -> Column:
    """Which of the four confusion cells a row belongs to."""
    actual, predicted = as_column(y), as_column(prediction)
    return case_when(
        [
            ((actual == 1) & (predicted == 1), F.lit("True positive")),
            ((actual == 0) & (predicted == 0), F.lit("True negative")),
            ((actual == 0) & (predicted == 1), F.lit("False positive")),
            ((actual == 1) & (predicted == 0), F.lit("False negative")),
        ],
        F.lit("Unknown"),
    )


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def hash_order(key: str | Sequence[str], seed: int = 42) -> Column:
    """A reproducible random order: 32 hex digits that depend on the key and the seed only."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = ", ".join(f"string({quoted(k)})" for k in keys)
    return F.expr(f"md5(concat_ws('|', {parts}, '{seed}'))")


def hash_fraction(key: str | Sequence[str], seed: int = 42) -> Column:
    """The same order as a number in [0, 1), from the first 12 hex digits."""
    head = F.conv(F.substring(hash_order(key, seed), 1, 12), 16, 10)
    return head.cast("double") / F.lit(float(16**12))


def yeo_johnson_sql(x: str, lam: float) -> str:
    """Yeo-Johnson power transform of the SQL text ``x`` at a fixed lambda."""
    mirror = 2.0 - lam
    upper = f"expm1(log1p({x}) * {lam!r}D) / {lam!r}D" if abs(lam) >= 1e-12 else f"log1p({x})"
    lower = (
        f"-expm1(log1p(-{x}) * {mirror!r}D) / {mirror!r}D"
        if abs(mirror) >= 1e-12
        else f"-log1p(-{x})"
    )
    return f"CASE WHEN {x} >= 0 THEN {upper} WHEN {x} < 0 THEN {lower} END"


def yeo_johnson(c: str, lam: float) -> Column:
    """Yeo-Johnson power transform of a column."""
    return F.expr(yeo_johnson_sql(f"double({quoted(c)})", lam))


def bin_index(c: str | Column, low: float, width: float, bins: int) -> Column:
    """Equal-width bin number from 0; the top edge belongs to the last bin."""
    x = as_column(c).cast("double")
    if width <= 0:
        return F.when(x.isNotNull(), F.lit(0).cast("bigint"))
    raw = F.floor((x - F.lit(low)) / F.lit(width)).cast("bigint")
    return F.when(x.isNotNull(), F.greatest(F.least(raw, F.lit(bins - 1)), F.lit(0)))
