"""Queries over files, missing values, names and requests: the given tables written out and read back as raw input."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tallymark.functions.columns import numeric_columns
from tallymark.operators.features import MedianImputer, RobustScale
from tallymark.operators.models import MajorityClass
from tallymark.operators.ordering import head, most_frequent, outer_align, top_k
from tallymark.plans.frames import MESSY_SQL, messy_events
from tallymark.plans.queries_profile import rounded
from tallymark.plans.registry import query, table
from tallymark.plans.scoring import cached_model, score
from tallymark.session import scratch_path
from tallymark.sources.ingest import apply_casts, ingest, nan_to_null, read_csv, read_csv_checked, rename, save_artifact, to_frame
from tallymark.spec import NULL_TOKENS, TableSpec

_TOKENS = ", ".join(f"'{t}'" for t in NULL_TOKENS)
CSV_SPEC = TableSpec(
    columns=("event_id", "value", "event_type", "k"),
    renames={"k": "kind_number"},
    casts={"event_id": "bigint", "value": "double", "event_type": "string", "kind_number": "bigint"},
    target="kind_number",
    target_map={},
)


@query(
    "SELECT event_id, TRY_CAST(value AS DOUBLE) AS value, "
    f"CASE WHEN event_type NOT IN ({_TOKENS}) THEN event_type END AS event_type, "
    f"CAST(TRY_CAST(k AS DOUBLE) AS BIGINT) AS kind_number FROM ({MESSY_SQL})"
)
def csv_ingest(spark, sf):
    """Events as a CSV with extra empty columns, read back by a list of columns and typed."""
    path = scratch_path(spark, "csv")
    empty = {f"extra_{i}": F.lit(None).cast("string") for i in range(20)}
    messy_events(spark, sf).withColumns(empty).write.option("header", True).option("escape", '"').csv(path)
    return ingest(read_csv(spark, path, CSV_SPEC), CSV_SPEC)


_LINES = '''CASE WHEN event_id % 97 = 5 THEN event_id || ',' || value || ',' || event_type || ',1,more'
  WHEN event_id % 101 = 7 THEN event_id || ',' || value
  WHEN event_id % 103 = 9 THEN event_id || ',' || value || ',"' || event_type || ',1'
  ELSE event_id || ',' || value || ',"' || event_type || ', ""as such""",1' END'''
MALFORMED_SPEC = TableSpec(
    columns=("event_id", "event_type"), casts={"event_id": "bigint"}, target="event_type", target_map={}
)


@query(
    "SELECT CASE WHEN kind = 'fine' THEN event_id END AS event_id, CASE WHEN kind = 'fine' THEN event_type || ', \"as such\"' END AS event_type, "
    "kind, CASE WHEN kind <> 'fine' THEN line END AS line FROM (SELECT event_id, event_type, CASE WHEN event_id % 97 = 5 THEN 'too many cells' "
    f"WHEN event_id % 101 = 7 THEN 'too few cells' WHEN event_id % 103 = 9 THEN 'open quote' ELSE 'fine' END AS kind, {_LINES} AS line "
    "FROM (SELECT event_id, event_type, CAST(floor(value) AS BIGINT) AS value FROM events))"
)
def csv_quarantine(spark, sf):
    """Events as CSV lines, some with too many or too few cells or a quote that stays open: typed rows beside the malformed lines."""
    path = scratch_path(spark, "lines")
    events = table(spark, sf, "events").withColumn("value", F.floor("value").cast("bigint"))
    lines = events.select(F.expr(_LINES).alias("value"), F.pmod("event_id", F.lit(4)).alias("part"), F.lit(1).alias("place"))
    heads = spark.range(4).select(F.lit("event_id,value,event_type,k").alias("value"), F.col("id").alias("part"), F.lit(0).alias("place"))
    ordered = lines.unionByName(heads).repartition("part").sortWithinPartitions("part", "place")
    ordered.select("value", "part").write.partitionBy("part").text(path)
    good, bad = read_csv_checked(spark, f"{path}/part=*", MALFORMED_SPEC)
    kept = apply_casts(good, MALFORMED_SPEC.casts).select("event_id", "event_type", F.lit("fine").alias("kind"), F.lit(None).cast("string").alias("line"))
    return kept.unionByName(bad.withColumnRenamed("problem", "kind"), allowMissingColumns=True)


_NAN_SQL = "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN 'NaN'::DOUBLE ELSE value END AS value FROM events"


def _nan_events(spark, sf):
    value = F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", value.alias("value"))


@query(f"SELECT event_id, CASE WHEN NOT isnan(value) THEN value END AS value FROM ({_NAN_SQL})")
def nan_as_missing(spark, sf):
    return nan_to_null(_nan_events(spark, sf))


@query(
    "WITH q AS (SELECT quantile_cont(value, 0.25) AS lo, quantile_cont(value, 0.5) AS mid, quantile_cont(value, 0.75) AS hi "
    "FROM events WHERE event_id % 5 <> 0) "
    "SELECT event_id, round((CASE WHEN event_id % 5 = 0 THEN mid ELSE value END - mid) / (hi - lo), 6) AS value FROM events, q"
)
def scaled_with_nan(spark, sf):
    """Median and quartiles are learned without the NaN cells, which the median then fills."""
    rows = _nan_events(spark, sf)
    filled = MedianImputer(["value"]).fit(rows).transform(rows)
    return rounded(RobustScale(["value"]).fit(rows).transform(filled), 6, "value")


@query("SELECT event_id + 9007199254740993 AS big_id, user_id AS person FROM events")
def wide_integers(spark, sf):
    """Integers beyond 2^53, from text and from integers, keep all their digits."""
    raw = table(spark, sf, "events").select((F.col("event_id") + F.lit(9007199254740993)).cast("string").alias("id"), "user_id")
    return apply_casts(rename(raw, {"id": "big_id", "user_id": "person"}), {"big_id": "bigint", "person": "bigint"})


@query(
    "SELECT column_name AS \"column\" FROM (SELECT * FROM (VALUES ('l_orderkey'), ('l_partkey'), ('l_suppkey'), ('l_linenumber'), "
    "('l_quantity'), ('l_extendedprice'), ('l_discount'), ('l_tax')) t(column_name)), (SELECT count(*) AS n FROM lineitem) WHERE n > 0"
)
def numeric_column_names(spark, sf):
    """The numeric columns of the line items that hold a value."""
    lines = table(spark, sf, "lineitem")
    names = numeric_columns(lines)
    counts = lines.agg(*[F.count(c).alias(c) for c in names]).unpivot([], names, "column", "n")
    return counts.filter("n > 0").select("column")


_MODES = " UNION ALL ".join(
    f"SELECT * FROM (SELECT '{c}' AS \"column\", {c}::VARCHAR AS value, count(*) AS count FROM lineitem WHERE {c} IS NOT NULL "
    f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)" for c in ("l_returnflag", "l_linenumber", "l_suppkey")
)


@query(_MODES)
def mixed_type_modes(spark, sf):
    return most_frequent(table(spark, sf, "lineitem"), ["l_returnflag", "l_linenumber", "l_suppkey"])


@query("SELECT * FROM (SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 25)")
def dearest_orders(spark, sf):
    return top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), 25, ["o_totalprice", "o_orderkey"])


@query("SELECT * FROM (SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 5)")
def first_events(spark, sf):
    return head(table(spark, sf, "events").select("event_id", "event_type"), 5, ["event_id"])


@query(
    "SELECT coalesce(a.user_id, b.user_id) AS user_id, a.n AS clicks, b.n AS purchases FROM "
    "(SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) a FULL JOIN "
    "(SELECT user_id, count(*) AS n FROM events WHERE event_type = 'purchase' GROUP BY 1) b ON a.user_id = b.user_id"
)
def aligned_counts(spark, sf):
    """Clicks and purchases of every user who has either."""
    events = table(spark, sf, "events")
    count = lambda kind: events.filter(F.col("event_type") == kind).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    return outer_align({"clicks": count("click"), "purchases": count("purchase")}, ["user_id"], "n")


@query(
    "SELECT event_id, (SELECT CASE WHEN 2 * count(*) FILTER (WHERE event_type = 'purchase') > count(*) THEN 1 ELSE 0 END FROM events)::BIGINT AS predicted FROM events"
)
def cached_model_scores(spark, sf):
    """A saved model loaded through the cache, saved anew with other data and loaded again: the second one scores."""
    events = table(spark, sf, "events").select("event_id", "event_type")
    path = scratch_path(spark, "model")
    label = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    for learned in (events.select((1 - label).alias("label")), events.select(label.alias("label"))):
        save_artifact(PipelineModel([MajorityClass().fit(learned)]), {"model_name": "majority"}, path)
        model = cached_model(path)
    return score(model, events).select("event_id", "predicted")


@query("SELECT lang, max(n_chars)::DOUBLE AS n_chars, count(*) AS documents FROM documents GROUP BY lang")
def request_rows(spark, sf):
    """One request per language built from its longest document."""
    found = table(spark, sf, "documents").groupBy("lang").agg(F.max("n_chars").cast("double").alias("n_chars"), F.count(F.lit(1)).alias("documents"))
    return to_frame(spark, found, "lang string, n_chars double, documents bigint")
