"""Reading, typing and writing tables; saving and loading fitted models."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.columns import as_column
from tallymark.spec import CSV_NULL_TOKENS, NULL_TOKENS, TableSpec


#: A line in which a cell begins with a quote that no later quote closes.
OPEN_QUOTE = r'^(?:(?:"(?:[^"]++|"")*+"|[^",][^,]*+|),)*+"(?:[^"]++|"")*+$'


class SourceMissing(FileNotFoundError):
    """The path of a source does not exist."""


class SourceUnreadable(ValueError):
    """The source exists but is not the table that was asked for."""


class ArtifactMissing(FileNotFoundError):
    """No saved model at the given path."""


def read_csv(spark: SparkSession, path: str, spec: TableSpec, multi_line: bool = False) -> DataFrame:
    """Header CSV, every cell as text, only the listed columns; extra columns are never parsed.

    Quoted line breaks need ``multi_line``, which gives up splitting a file into tasks.
    """
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    try:
        raw = reader.csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise SourceMissing(path) from error
        raise SourceUnreadable(f"{path}: {error}") from error
    absent = [c for c in spec.columns if c not in raw.columns]
    if absent:
        raise SourceUnreadable(f"{path}: missing columns {absent}")
    return unify_nulls(raw.select(*[F.col(f"`{c}`") for c in spec.columns]), CSV_NULL_TOKENS)


def read_csv_checked(
    spark: SparkSession, path: str, spec: TableSpec, strict: bool = False, multi_line: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``read_csv`` that tells malformed rows: the well-formed ones, and ``line, problem`` of the others.

    A row is malformed if it has more or fewer cells than the header, be it for a quote that swallows the cells behind it; an open quote
    in the last cell ends with the line. With ``strict`` the first malformed row that is read fails the job with its text. Every cell
    has to be parsed to know (a reader that prunes columns takes such rows for good ones), so no column is left out of the scan.
    """
    if spec.columns:
        read_csv(spark, path, spec, multi_line)  # the path and the columns
    reader = spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')
    header = reader.csv(path).columns
    line = "line"
    while line in header:
        line += "_"
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, line]])
    cells = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", line).schema(schema).csv(path)
    # a plan that reads nothing but the malformed text is not allowed, so the last cell comes along
    text = F.element_at(F.array(F.col(f"`{line}`"), F.col(f"`{header[-1]}`")), 1)
    open_quote = text.rlike(OPEN_QUOTE)
    short = F.col(f"`{header[-1]}`").isNull()
    problem = F.when(open_quote, "open quote").when(short, "too few cells").otherwise("too many cells")
    listed = [F.col(f"`{c}`") for c in spec.columns]
    if strict:
        message = F.concat(F.lit(f"{path}: "), problem, F.lit(": "), text)
        good = cells.filter(F.when(text.isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True))
    else:
        good = cells.filter(text.isNull())
    bad = cells.filter(text.isNotNull()).select(text.alias("line"), problem.alias("problem"))
    return unify_nulls(good.select(*listed), CSV_NULL_TOKENS), bad


def unify_nulls(df: DataFrame, tokens: Iterable[str] = NULL_TOKENS) -> DataFrame:
    """Null instead of any of the tokens, in every text column, matched exactly."""
    listed = list(tokens)
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    return df.select(
        *[
            F.when(~F.col(c).isin(listed), F.col(c)).alias(c) if c in texts else F.col(c)
            for c in df.columns
        ]
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN becomes null."""
    floats = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(
        *[
            F.when(~F.isnan(c), F.col(c)).alias(c) if c in floats else F.col(c)
            for c in df.columns
        ]
    )


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def cast_column(c, kind: str):
    """Cast without raising: what does not parse (or is no whole number, for integers) is null."""
    column = as_column(c)
    if kind in ("bigint", "int", "smallint", "tinyint"):
        # the text form keeps all 64 bits; "65.0" and the like go through a double
        number = column.try_cast("double")
        whole = F.when(number == F.floor(number), number.try_cast(kind))
        return F.coalesce(column.cast("string").try_cast(kind), whole)
    return column.try_cast(kind)


def apply_casts(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    return df.select(
        *[
            cast_column(c, casts[c]).alias(c) if c in casts else F.col(c)
            for c in df.columns
        ]
    )


def ingest(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Raw text columns to the typed table: rename, null tokens, casts, one missing notion."""
    named = rename(df, spec.renames)
    return nan_to_null(apply_casts(unify_nulls(named, spec.null_tokens), spec.casts))


def layer_path(base: str, layer: str, name: str) -> str:
    return f"{base.rstrip('/')}/{layer}/{name}"


def write_layer(df: DataFrame, base: str, layer: str, name: str) -> str:
    """Overwrite one table of a layer and return its path."""
    path = layer_path(base, layer, name)
    df.write.mode("overwrite").parquet(path)
    return path


def read_layer(spark: SparkSession, base: str, layer: str, name: str) -> DataFrame:
    return read_table(spark, layer_path(base, layer, name))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise SourceMissing(path) from error
        raise SourceUnreadable(f"{path}: {error}") from error


def verify_roundtrip(df: DataFrame, path: str) -> bool:
    """Same shape after writing: names, types and number of rows."""
    back = read_table(df.sparkSession, path)
    same = [(f.name, f.dataType) for f in back.schema] == [(f.name, f.dataType) for f in df.schema]
    return same and back.count() == df.count()


def to_frame(
    spark: SparkSession, rows: Sequence[Mapping[str, Any]] | DataFrame, schema: T.StructType | str
) -> DataFrame:
    """Request values as a frame in the declared column order; unknown or absent names raise.

    Rows that are a frame already are cast to the declared types and never pass through the driver.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if isinstance(rows, DataFrame):
        if sorted(rows.columns) != sorted(kind.names):
            raise SourceUnreadable(f"expected the columns {kind.names}, got {sorted(rows.columns)}")
        return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kind])
    for row in rows:
        if set(row) != set(kind.names):
            raise SourceUnreadable(f"expected the columns {kind.names}, got {sorted(row)}")
    return spark.createDataFrame([tuple(row[c] for c in kind.names) for row in rows], kind)


def save_artifact(model: PipelineModel, meta: Mapping[str, Any], path: str) -> None:
    """Fitted stages and one line of metadata below one path."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    line = json.dumps(dict(meta), sort_keys=True)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/metadata"
    )


def load_artifact(spark: SparkSession, path: str) -> tuple[PipelineModel, dict[str, Any]]:
    try:
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
    except AnalysisException as error:
        raise ArtifactMissing(f"no model at {path}") from error
    return PipelineModel.load(f"{path}/model"), meta
