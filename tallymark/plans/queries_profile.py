"""Queries over ingest, quality, profile and association operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymark.functions.columns import cut, map_values, safe_ratio
from tallymark.operators import association as assoc
from tallymark.operators import describe as desc
from tallymark.operators import quality
from tallymark.operators.ordering import sample_rows
from tallymark.operators.prepare import drop_null_rows
from tallymark.plans.frames import (
    DOCS_SQL,
    EVENT_SPEC,
    MESSY_SQL,
    TYPED_SQL,
    labelled_docs,
    landed_docs,
    landed_events,
    messy_events,
    order_sql,
)
from tallymark.plans.registry import query, table
from tallymark.plans.scoring import contract_rules
from tallymark.session import scratch_path
from tallymark.sources.ingest import ingest, read_layer, write_layer

LINE = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def rounded(df, digits: int, *cols: str):
    return df.withColumns({c: F.round(c, digits) for c in cols})


def stacked(template: str, cols) -> str:
    """The same SELECT for several columns, one below the other."""
    return " UNION ALL ".join(template.replace("{c}", c) for c in cols)


# ------------------------------------------------------------------ ingest
@query(TYPED_SQL)
def typed_events(spark, sf):
    return ingest(messy_events(spark, sf), EVENT_SPEC)


@query("SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_acctbal > 0")
def layer_roundtrip(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    base = scratch_path(spark, "layers")
    write_layer(rows.filter("c_acctbal > 0"), base, "intermediate", "customer")
    return read_layer(spark, base, "intermediate", "customer")


@query(
    f"SELECT event_id, CASE WHEN k = 0 THEN NULL ELSE value / k END AS ratio, "
    f"CASE code WHEN 1 THEN 'bought' WHEN 2 THEN 'other' ELSE 'unknown' END AS shown, "
    f"CASE WHEN value >= 50 THEN 'high' WHEN value >= 10 THEN 'middle' ELSE 'low' END AS band, "
    f"coalesce(event_type IN ('click', 'purchase'), FALSE) AS active "
    f"FROM ({TYPED_SQL}) WHERE value IS NOT NULL"
)
def mapped_columns(spark, sf):
    from tallymark.functions.columns import case_when

    typed = drop_null_rows(ingest(messy_events(spark, sf), EVENT_SPEC), ["value"])
    value = F.col("value")
    return typed.select(
        "event_id",
        safe_ratio("value", "k").alias("ratio"),
        map_values("code", {1: "bought", 2: "other"}, "unknown").alias("shown"),
        case_when([(value >= 50, F.lit("high")), (value >= 10, F.lit("middle"))], "low").alias("band"),
        F.coalesce(F.col("event_type").isin("click", "purchase"), F.lit(False)).alias("active"),
    )


@query(
    f"SELECT o_orderkey, o_totalprice FROM orders ORDER BY {order_sql('o_orderkey')} LIMIT 500"
)
def random_sample(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return sample_rows(orders, 500, "o_orderkey")


@query("SELECT DISTINCT p_type FROM part")
def distinct_part_types(spark, sf):
    return assoc.distinct_values(table(spark, sf, "part"), "p_type")


# ------------------------------------------------------------------ quality
@query(
    "SELECT * FROM ("
    + stacked(
        f"SELECT '{{c}}' AS \"column\", count(*) - count({{c}}) AS nulls, "
        f"round(100.0::DOUBLE * (count(*) - count({{c}})) / count(*), 4) AS pct FROM ({TYPED_SQL})",
        ["event_id", "user_id", "value", "event_type", "k", "code"],
    )
    + ") WHERE nulls > 0"
)
def null_profile(spark, sf):
    return quality.null_profile(ingest(messy_events(spark, sf), EVENT_SPEC), decimals=4)


@query(
    "SELECT CAST(sum(n) AS BIGINT) AS row_count, CAST(sum(n - 1) AS BIGINT) AS duplicates, "
    "round(100.0::DOUBLE * sum(n - 1) / sum(n), 4) AS pct "
    "FROM (SELECT count(*) AS n FROM documents GROUP BY text, lang)"
)
def duplicate_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return quality.duplicate_summary(docs, ["text", "lang"], decimals=4, digest=True)


@query(
    "SELECT user_id, event_type FROM (SELECT user_id, event_type, count(*) OVER "
    "(PARTITION BY user_id, event_type) AS n FROM events) WHERE n > 1 "
    "ORDER BY user_id, event_type LIMIT 5"
)
def first_duplicate_rows(spark, sf):
    return quality.duplicate_rows(table(spark, sf, "events"), ["user_id", "event_type"])


@query(
    "SELECT l_quantity, l_discount, l_tax, l_returnflag, l_linestatus FROM "
    "(SELECT *, count(*) OVER (PARTITION BY l_quantity, l_discount, l_tax, l_returnflag, "
    "l_linestatus) AS n FROM lineitem) WHERE n > 1"
)
def all_duplicate_rows(spark, sf):
    cols = ["l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
    return quality.duplicate_rows(table(spark, sf, "lineitem"), cols, limit=None)


@query(
    f"WITH d AS (SELECT user_id, event_type, code FROM ({TYPED_SQL})), "
    "g AS (SELECT user_id, event_type, code, count(*) AS n FROM d GROUP BY ALL) "
    "SELECT 'Missing target' AS metric, "
    "CAST(sum(CASE WHEN code IS NULL THEN n ELSE 0 END) AS BIGINT) AS count, "
    "round(100.0::DOUBLE * sum(CASE WHEN code IS NULL THEN n ELSE 0 END) / sum(n), 4) AS percentage FROM g "
    "UNION ALL SELECT 'Exact duplicate rows', CAST(sum(n - 1) AS BIGINT), "
    "round(100.0::DOUBLE * sum(n - 1) / sum(n), 4) FROM g"
)
def quality_summary(spark, sf):
    typed = ingest(messy_events(spark, sf), EVENT_SPEC).select("user_id", "event_type", "code")
    return quality.quality_summary(typed, "code", decimals=4)


@query(
    " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{t}' AS dtype, "
        f"count({c}) AS non_null, count(*) AS row_count FROM ({TYPED_SQL})"
        for i, (c, t) in enumerate(
            [("event_id", "bigint"), ("user_id", "bigint"), ("value", "double"),
             ("event_type", "string"), ("k", "bigint"), ("code", "bigint")]
        )
    )
)
def frame_info(spark, sf):
    return quality.frame_info(ingest(messy_events(spark, sf), EVENT_SPEC))


_RULES = {
    "value >= 5": "value < 5",
    "value <= 100": "value > 100",
    "k >= 10": "k < 10",
    "event_type in [''click'', ''purchase'', ''signup'']":
        "event_type NOT IN ('click', 'purchase', 'signup')",
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS rule, count(*) FILTER (WHERE {bad}) AS violations, "
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE {bad}) / count(*), 4) AS pct FROM ({TYPED_SQL})"
        for name, bad in _RULES.items()
    )
)
def rule_violations(spark, sf):
    report, _, _ = quality.validate(
        ingest(messy_events(spark, sf), EVENT_SPEC), contract_rules(EVENT_SPEC)
    )
    return rounded(report, 4, "pct")


@query(
    f"SELECT event_id, concat_ws('; ', "
    + ", ".join(f"CASE WHEN {bad} THEN '{name}' END" for name, bad in _RULES.items())
    + f") AS broken FROM ({TYPED_SQL}) WHERE "
    + " OR ".join(f"coalesce({bad}, FALSE)" for bad in _RULES.values())
)
def quarantined_rows(spark, sf):
    _, _, bad = quality.validate(
        ingest(messy_events(spark, sf), EVENT_SPEC), contract_rules(EVENT_SPEC)
    )
    return bad.select("event_id", F.concat_ws("; ", "broken_rules").alias("broken"))


@query(
    "SELECT lang, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM documents), 6) "
    "AS share FROM documents GROUP BY lang"
)
def class_balance(spark, sf):
    return quality.class_balance(table(spark, sf, "documents"), "lang", 6)


# ------------------------------------------------------------------ describe
_DESCRIBE = (
    "SELECT {by}'{c}' AS \"column\", count({c}) AS count, round(avg({c}), 4) AS mean, "
    "round(stddev_samp({c}), 4) AS std, round(min({c})::DOUBLE, 4) AS min, "
    "round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50, "
    "round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75, round(max({c})::DOUBLE, 4) AS max FROM {t}{group}"
)
_PARTS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


@query(
    stacked(_DESCRIBE.replace("{by}", "").replace("{t}", "lineitem").replace("{group}", ""), LINE)
)
def describe_lineitem(spark, sf):
    return rounded(desc.describe(table(spark, sf, "lineitem"), LINE), 4, *_PARTS)


@query(
    stacked(
        _DESCRIBE.replace("{by}", "event_type, ").replace("{t}", f"({TYPED_SQL})").replace(
            "{group}", " GROUP BY event_type"
        ),
        ["value", "k"],
    )
)
def describe_events_by_type(spark, sf):
    typed = landed_events(spark, sf)
    return rounded(desc.describe(typed, ["value", "k"], ["event_type"]), 4, *_PARTS)


def _box_sql(cols, source, by=""):
    group = f"{by}, " if by else ""
    on = f"d.{by} IS NOT DISTINCT FROM q.{by}" if by else "TRUE"
    tail = f" GROUP BY q.{by}" if by else ""
    parts = []
    for c in cols:
        parts.append(
            f"SELECT {f'q.{by}, ' if by else ''}'{c}' AS \"column\", count(d.{c}) AS count, "
            f"round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3, "
            f"round(min(CASE WHEN d.{c} >= q1 - 1.5::DOUBLE * (q3 - q1) THEN d.{c}::DOUBLE END), 4) AS whisker_low, "
            f"round(max(CASE WHEN d.{c} <= q3 + 1.5::DOUBLE * (q3 - q1) THEN d.{c}::DOUBLE END), 4) AS whisker_high, "
            f"count(CASE WHEN d.{c} < q1 - 1.5::DOUBLE * (q3 - q1) OR d.{c} > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 END) AS outliers "
            f"FROM {source} d JOIN (SELECT {group}quantile_cont({c}::DOUBLE, 0.25) AS q1, "
            f"quantile_cont({c}::DOUBLE, 0.5) AS median, quantile_cont({c}::DOUBLE, 0.75) AS q3 FROM {source}"
            f"{f' GROUP BY {by}' if by else ''}) q ON {on}{tail}"
        )
    return " UNION ALL ".join(parts)


_BOX = ["q1", "median", "q3", "whisker_low", "whisker_high"]


@query(_box_sql(["l_extendedprice", "l_quantity"], "lineitem"))
def box_statistics(spark, sf):
    out = desc.box_stats(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"])
    return rounded(out, 4, *_BOX)


@query(_box_sql(["n_chars", "n_words"], f"({DOCS_SQL})", "quality"))
def box_statistics_by_class(spark, sf):
    out = desc.box_stats(landed_docs(spark, sf), ["n_chars", "n_words"], ["quality"])
    return rounded(out, 4, *_BOX)


@query("""
WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
    quantile_cont(value, 0.75) - quantile_cont(value, 0.25) AS iqr FROM events),
b AS (SELECT lo, hi, CAST(ceil((hi - lo) / least((hi - lo) / (log2(n) + 1),
    2 * iqr / pow(n, 1.0::DOUBLE / 3))) AS BIGINT) AS bins FROM s),
w AS (SELECT lo, bins, (hi - lo) / bins AS width FROM b),
h AS (SELECT least(CAST(floor((value - lo) / width) AS BIGINT), bins - 1) AS bin, count(*) AS n
    FROM events, w GROUP BY 1)
SELECT g.bin, round(lo + width * g.bin, 6) AS low, round(lo + width * (g.bin + 1), 6) AS high,
  g.n
FROM h g, w""")
def histogram_automatic(spark, sf):
    return rounded(desc.histogram(table(spark, sf, "events"), "value"), 6, "low", "high")


@query("""
WITH w AS (SELECT min(l_extendedprice) AS lo,
    (max(l_extendedprice) - min(l_extendedprice)) / 12 AS width FROM lineitem)
SELECT l_returnflag, least(CAST(floor((l_extendedprice - lo) / width) AS BIGINT), 11) AS bin,
  round(any_value(lo + width * least(floor((l_extendedprice - lo) / width), 11)), 4) AS low,
  round(any_value(lo + width * (least(floor((l_extendedprice - lo) / width), 11) + 1)), 4) AS high,
  count(*) AS n
FROM lineitem, w GROUP BY 1, 2""")
def histogram_by_flag(spark, sf):
    out = desc.histogram(table(spark, sf, "lineitem"), "l_extendedprice", 12, ["l_returnflag"])
    return rounded(out, 4, "low", "high")


@query("""
WITH s AS (SELECT count(value) AS n, min(value) AS lo, max(value) AS hi,
    stddev_samp(value) * pow(count(value), -0.2::DOUBLE) AS h FROM events),
g AS (SELECT unnest(range(20)) AS i)
SELECT round(lo + i * ((hi - lo) / 19), 6) AS x,
  round(sum(exp(-0.5::DOUBLE * pow((value - (lo + i * ((hi - lo) / 19))) / h, 2)))
    / any_value(n * h * sqrt(2 * pi())), 8) AS density
FROM g, s, events GROUP BY i, lo, hi""")
def kernel_density(spark, sf):
    out = desc.kde(table(spark, sf, "events"), "value")
    return out.select(F.round("x", 6).alias("x"), F.round("density", 8).alias("density"))


@query(
    stacked(
        "SELECT '{c}' AS \"column\", round(m3 / pow(m2, 1.5::DOUBLE), 6) AS skewness, "
        "round(m4 / (m2 * m2) - 3, 6) AS kurtosis, round(variance, 4) AS variance, "
        "round(hi - lo, 4) AS range, mode FROM (SELECT avg(pow(x - mu, 2)) AS m2, "
        "avg(pow(x - mu, 3)) AS m3, avg(pow(x - mu, 4)) AS m4, var_samp(x) AS variance, "
        "max(x) AS hi, min(x) AS lo FROM (SELECT {c}::DOUBLE AS x, avg({c}) OVER () AS mu FROM lineitem)), "
        "(SELECT {c}::DOUBLE AS mode FROM lineitem GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)",
        LINE,
    )
)
def moments(spark, sf):
    out = desc.moments(table(spark, sf, "lineitem"), LINE)
    return rounded(rounded(out, 6, "skewness", "kurtosis"), 4, "variance", "range")


# ------------------------------------------------------------------ association
@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, "
        + ("1.0::DOUBLE" if a == b else f"round(corr({a}, {b}), 6)")
        + f" AS r FROM {'lineitem LIMIT 1' if a == b else 'lineitem'}"
        if a != b
        else f"(SELECT '{a}' AS a, '{b}' AS b, 1.0::DOUBLE AS r)"
        for a in LINE
        for b in LINE
    )
)
def correlation_matrix(spark, sf):
    return rounded(assoc.corr_matrix(table(spark, sf, "lineitem"), LINE), 6, "r")


@query("""
WITH v AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, unnest(embedding)::DOUBLE AS x FROM embeddings)
SELECT 'd' || a.i AS a, 'd' || b.i AS b, CASE WHEN a.i = b.i THEN 1.0::DOUBLE ELSE round(corr(a.x, b.x), 6) END AS r
FROM v a JOIN v b USING (vec_id) GROUP BY a.i, b.i""")
def wide_correlation(spark, sf):
    """Every pair of vector components, one column each."""
    vectors = table(spark, sf, "embeddings")
    dims = vectors.agg(F.max(F.size("embedding"))).first()[0]
    columns = vectors.select(*[F.get("embedding", F.lit(i)).alias(f"d{i}") for i in range(dims)])
    return rounded(assoc.corr_matrix(columns, columns.columns), 6, "r")


_DOC_NUM = ["n_chars", "n_words", "n_lines", "n_digits"]


@query(
    stacked(
        f"SELECT '{{c}}' AS \"column\", round(corr({{c}}, quality), 3) AS r FROM ({DOCS_SQL})", _DOC_NUM
    )
)
def target_correlation(spark, sf):
    return assoc.target_corr(labelled_docs(spark, sf), _DOC_NUM, "quality")


@query(
    "SELECT l_returnflag, "
    + ", ".join(
        f"round(100.0::DOUBLE * count(*) FILTER (WHERE l_linestatus = '{v}') / count(*), 4) AS \"{v}\""
        for v in "FO"
    )
    + " FROM lineitem GROUP BY l_returnflag"
)
def crosstab_percent(spark, sf):
    return assoc.crosstab_pct(
        table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", decimals=4
    )


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY lang, source")
def two_way_counts(spark, sf):
    return assoc.two_way_counts(table(spark, sf, "documents"), "lang", "source")


@query(
    stacked(
        f"SELECT quality, '{{c}}' AS \"column\", count({{c}}) AS count, round(avg({{c}}), 4) AS mean, "
        f"round(quantile_cont({{c}}::DOUBLE, 0.5), 4) AS median, round(stddev_samp({{c}}), 4) AS std "
        f"FROM ({DOCS_SQL}) GROUP BY quality",
        _DOC_NUM,
    )
)
def grouped_summary(spark, sf):
    return assoc.grouped_summary(landed_docs(spark, sf), _DOC_NUM, ["quality"], decimals=4)


_EDGES = [0, 500, 1500, 4000, 40000]
_BANDS = ["0-500", "501-1500", "1501-4000", "4001-40000"]
_CUT_SQL = (
    "CASE WHEN n_chars >= 0 AND n_chars <= 500 THEN '0-500' WHEN n_chars > 500 AND n_chars <= 1500 "
    "THEN '501-1500' WHEN n_chars > 1500 AND n_chars <= 4000 THEN '1501-4000' "
    "WHEN n_chars > 4000 AND n_chars <= 40000 THEN '4001-40000' END"
)
_RATE_SQL = (
    f"SELECT {_CUT_SQL} AS size_group, lang, count(*) AS n, "
    "round(avg(CASE WHEN quality = 1 THEN 1.0::DOUBLE ELSE 0.0 END) * 100, 4) AS rate "
    "FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE n_chars >= 0 AND n_chars <= 40000 "
    "GROUP BY 1, 2"
)


def size_and_language_rate(spark, sf):
    """The flagship: a right-closed size group by category, rows and positive rate."""
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    joined = drop_null_rows(docs.join(labels, "doc_id"), ["quality"])
    binned = joined.withColumn("size_group", cut("n_chars", _EDGES, _BANDS))
    return assoc.rate_by(binned, ["size_group", "lang"], F.col("quality") == 1, decimals=4)


query(_RATE_SQL)(size_and_language_rate)


@query(
    "SELECT size_group, "
    + ", ".join(f"max(CASE WHEN lang = '{v}' THEN rate END) AS {v}" for v in ("de", "en", "es", "fr"))
    + f" FROM ({_RATE_SQL}) GROUP BY size_group"
)
def rate_matrix(spark, sf):
    rates = size_and_language_rate(spark, sf)
    return assoc.unstack(rates, "size_group", "lang", "rate", ["de", "en", "es", "fr"])


@query("""
WITH w AS (SELECT min(l_quantity) AS xl, (max(l_quantity) - min(l_quantity)) / 10 AS xw,
  min(l_extendedprice) AS yl, (max(l_extendedprice) - min(l_extendedprice)) / 10 AS yw FROM lineitem)
SELECT l_returnflag, least(CAST(floor((l_quantity - xl) / xw) AS BIGINT), 9) AS xbin,
  least(CAST(floor((l_extendedprice - yl) / yw) AS BIGINT), 9) AS ybin, count(*) AS n,
  round(avg(l_quantity), 6) AS x_mean, round(avg(l_extendedprice), 6) AS y_mean
FROM lineitem, w GROUP BY 1, 2, 3""")
def binned_scatter(spark, sf):
    out = assoc.binned_scatter(
        table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", ["l_returnflag"], 10, 10
    )
    return rounded(out, 6, "x_mean", "y_mean")


@query(
    f"SELECT event_id, value, k FROM ({TYPED_SQL}) WHERE value IS NOT NULL AND k IS NOT NULL "
    f"ORDER BY {order_sql('event_id')} LIMIT 300"
)
def scatter_sample(spark, sf):
    typed = ingest(messy_events(spark, sf), EVENT_SPEC)
    return assoc.scatter_sample(typed, ["value", "k"], 300, "event_id")


def _pair_sql(cols, source, by, bins):
    spans = ", ".join(
        f"min({c})::DOUBLE AS l{i}, (max({c}) - min({c}))::DOUBLE / {bins} AS w{i}" for i, c in enumerate(cols)
    )
    binned = ", ".join(
        f"least(CAST(floor(({c} - l{i}) / w{i}) AS BIGINT), {bins - 1}) AS b{i}" for i, c in enumerate(cols)
    )
    parts = [
        f"SELECT {by}, '{cols[i]}' AS a, '{cols[j]}' AS b, b{i} AS abin, b{j} AS bbin, count(*) AS n "
        f"FROM z GROUP BY {by}, b{i}, b{j}"
        for i in range(len(cols))
        for j in range(i, len(cols))
    ]
    return (
        f"WITH d AS ({source}), w AS (SELECT {spans} FROM d), z AS (SELECT {by}, {binned} FROM d, w) "
        + " UNION ALL ".join(parts)
    )


@query(_pair_sql(["n_chars", "n_words", "n_lines"], DOCS_SQL, "quality", 8))
def pair_summary(spark, sf):
    return assoc.pair_summary(
        landed_docs(spark, sf), ["n_chars", "n_words", "n_lines"], ["quality"], 8
    )
