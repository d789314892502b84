"""The tables the registered queries work on, each beside the SQL that builds the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.plans.registry import table
from tallymark.session import scratch_path
from tallymark.sources.ingest import ingest, write_layer
from tallymark.spec import Bound, TableSpec

HASH = "md5(concat_ws('|', CAST({key} AS VARCHAR), '{seed}'))"


def order_sql(key: str, seed: int = 42) -> str:
    return HASH.format(key=key, seed=seed)


# ------------------------------------------------------------------ events with missing values
MESSY_SQL = """
SELECT event_id, user_id,
  CASE WHEN value < 2 THEN '?' WHEN value > 150 THEN 'N/A' ELSE CAST(value AS VARCHAR) END AS value,
  CASE WHEN event_type = 'error' THEN ' ' ELSE event_type END AS event_type,
  regexp_extract(props, '[0-9]+') || '.0' AS k,
  CASE WHEN event_type = 'signup' THEN NULL WHEN event_type = 'purchase' THEN 1 ELSE 2 END AS code
FROM events"""


def messy_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event rows as raw text cells with several spellings of a missing value."""
    value, kind = F.col("value"), F.col("event_type")
    return table(spark, sf, "events").select(
        "event_id",
        "user_id",
        F.when(value < 2, "?").when(value > 150, "N/A").otherwise(value.cast("string")).alias("value"),
        F.when(kind == "error", " ").otherwise(kind).alias("event_type"),
        F.concat(F.regexp_extract("props", "[0-9]+", 0), F.lit(".0")).alias("k"),
        F.when(kind == "signup", None).when(kind == "purchase", 1).otherwise(2).alias("code"),
    )


TYPED_SQL = f"""
SELECT event_id, user_id, TRY_CAST(value AS DOUBLE) AS value,
  CASE WHEN event_type IN ('', ' ', 'NA', 'N/A', 'NULL', 'null', '?', '-') THEN NULL
    ELSE event_type END AS event_type,
  CAST(TRY_CAST(k AS DOUBLE) AS BIGINT) AS k, CAST(code AS BIGINT) AS code
FROM ({MESSY_SQL})"""

EVENT_SPEC = TableSpec(
    columns=("event_id", "user_id", "value", "event_type", "k", "code"),
    casts={
        "event_id": "bigint", "user_id": "bigint", "value": "double", "event_type": "string",
        "k": "bigint", "code": "bigint",
    },
    target="code",
    target_map={1: 1, 2: 0},
    skewed=("value",),
    regular=("k",),
    categorical=("event_type",),
    key="event_id",
    bounds={"value": Bound(5.0, 100.0), "k": Bound(10.0)},
    domains={"event_type": ("click", "purchase", "signup")},
)


# ------------------------------------------------------------------ labelled documents
DOCS_SQL = """
SELECT d.doc_id, d.n_chars,
  length(d.text) - length(replace(d.text, ' ', '')) + 1 AS n_words,
  length(d.text) - length(replace(d.text, chr(10), '')) + 1 AS n_lines,
  length(d.text) - length(translate(d.text, '0123456789', '')) AS n_digits,
  d.lang, l.quality
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


def labelled_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Text measurements of the labelled documents; the text itself is not kept.

    The measurements are made before the join, so only numbers are shuffled.
    """
    text = F.col("text")
    size = F.length(text)
    docs = table(spark, sf, "documents").select(
        "doc_id",
        "n_chars",
        (size - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1).cast("bigint").alias("n_words"),
        (size - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines"),
        (size - F.length(F.translate(text, "0123456789", ""))).cast("bigint").alias("n_digits"),
        "lang",
    )
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").cast("bigint").alias("quality"))
    return docs.join(labels, "doc_id")


def landed(df: DataFrame, name: str) -> DataFrame:
    """Write a typed table as a layer and go on from the files.

    Profiles and fits read their input several times; from here on they scan a few pruned
    columns instead of parsing text cells or whole documents again.
    """
    base = scratch_path(df.sparkSession, "layers")
    path = write_layer(df, base, "intermediate", name)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # a known schema saves a look into the files


def landed_docs(spark: SparkSession, sf: str) -> DataFrame:
    return landed(labelled_docs(spark, sf), "labelled_docs")


def landed_events(spark: SparkSession, sf: str) -> DataFrame:
    return landed(ingest(messy_events(spark, sf), EVENT_SPEC), "events")


DOC_SPEC = TableSpec(
    columns=("doc_id", "n_chars", "n_words", "n_lines", "n_digits", "lang", "quality"),
    casts={
        "n_chars": "double", "n_words": "double", "n_lines": "double", "n_digits": "double",
        "lang": "string", "quality": "bigint",
    },
    target="quality",
    target_map={1: 1, 0: 0},
    skewed=("n_chars", "n_words", "chars_per_word", "words_per_line"),
    regular=("n_lines", "n_digits"),
    categorical=("lang",),
    ratios=(
        ("chars_per_word", "n_chars", "n_words"),
        ("words_per_line", "n_words", "n_lines"),
    ),
    key="doc_id",
    bounds={"n_chars": Bound(1.0, 20000.0), "n_words": Bound(1.0)},
    domains={"lang": ("de", "en", "es", "fr")},
    labels={1: "good", 0: "poor"},
)

# ------------------------------------------------------------------ orders with a simple score
ORDERS_SQL = """
SELECT o_orderkey, o_orderpriority, o_totalprice,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label,
  round(o_totalprice / 1000.0, 0) AS score,
  CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS prediction
FROM orders"""


def scored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with a label, a score with many ties, and a thresholded prediction."""
    price = F.col("o_totalprice")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderpriority",
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("label"),
        F.round(price / 1000.0, 0).alias("score"),
        F.when(price > 250000, 1).otherwise(0).alias("prediction"),
    )


# ------------------------------------------------------------------ splits and folds in SQL
def split_sql(source: str, y: str, key: str, test: float = 0.2, seed: int = 42) -> str:
    """WITH clause whose last table ``s`` is the source with ``split``."""
    return f"""
WITH d AS ({source}),
c AS (SELECT {y} AS y, count(*) AS n FROM d GROUP BY 1),
w AS (SELECT ceil(CAST({test} AS DOUBLE) * sum(n)) AS wanted, sum(n) AS total FROM c),
q AS (SELECT y, n, wanted, CAST(wanted AS DOUBLE) * n / total AS quota FROM c, w),
f AS (SELECT y, floor(quota) AS base, quota - floor(quota) AS rest, wanted,
        sum(floor(quota)) OVER () AS given FROM q),
a AS (SELECT y, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, CAST(y AS VARCHAR))
        <= wanted - given THEN 1 ELSE 0 END AS take FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY {y} ORDER BY {order_sql(key, seed)}) AS rn FROM d),
s AS (SELECT r.*, CASE WHEN r.rn <= a.take THEN 'test' ELSE 'train' END AS split
      FROM r JOIN a ON r.{y} = a.y)
"""


def folds_sql(source: str, y: str, key: str, k: int = 5, seed: int = 42) -> str:
    """SELECT of the source with ``fold``."""
    return (
        f"SELECT *, ntile({k}) OVER (PARTITION BY {y} ORDER BY {order_sql(key, seed)}) AS fold "
        f"FROM ({source})"
    )
