"""Packing by optimal length buckets.

Dynamic programming over the global histogram of lengths chooses the bucket lengths that waste the least padding; inside each
bucket batches of a token budget are formed. Only the histogram (at most budget + 1 rows) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import fresh, numbered, saved

WORD = r"[^\x20\x09-\x0D]+"
BUDGET, BUCKETS = 8192, 8


def bucket_lengths(histogram: Sequence[tuple[int, int]], buckets: int) -> list[int]:
    """The lengths, at most `buckets`, that rows are padded to with the least padding; `histogram`: (length, rows).

    Of equally good choices the one whose buckets begin earliest is taken. The cost of a bucket is concave in its ends, so each
    step finds its best splits by divide and conquer: buckets * lengths * log(lengths) steps in all.
    """
    if not histogram:
        return []
    pairs = sorted(histogram)
    lengths = np.array([p[0] for p in pairs], np.int64)
    rows = np.concatenate([[0], np.cumsum([p[1] for p in pairs])]).astype(np.int64)
    tokens = np.concatenate([[0], np.cumsum([p[0] * p[1] for p in pairs])]).astype(np.int64)
    n = len(pairs)
    best, chosen = [(lengths * rows[1:] - tokens[1:])], [np.zeros(n, np.int64)]
    for b in range(1, min(buckets, n)):
        cost, split = np.zeros(n, np.int64), np.zeros(n, np.int64)
        spans = [(b, n - 1, b, n - 1)]
        while spans:
            lo, hi, first, last = spans.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            starts = np.arange(first, min(mid, last) + 1)
            waste = best[-1][starts - 1] + lengths[mid] * (rows[mid + 1] - rows[starts]) - (tokens[mid + 1] - tokens[starts])
            at = int(np.argmin(waste))
            cost[mid], split[mid] = waste[at], starts[at]
            spans += [(lo, mid - 1, first, int(starts[at])), (mid + 1, hi, int(starts[at]), last)]
        best.append(cost)
        chosen.append(split)
    ends, at = [], n - 1
    for b in range(len(best) - 1, -1, -1):
        ends.append(int(lengths[at]))
        at = int(chosen[b][at]) - 1
    return ends[::-1]


def word_count(text: Column) -> Column:
    """Words between white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def pack(df: DataFrame, key: str, length: str, budget: int = BUDGET, buckets: int = BUCKETS) -> DataFrame:
    """`key`, `length`, bucket, padded_length, batch and place for each row.

    A row longer than the budget is a batch of its own in the bucket after the last, unpadded; no row is cut or dropped. Every
    other batch holds as many rows as fit the budget at its bucket's padded length. A null length counts as 0, and rows of length 0 take the shortest bucket; keys
    may be null or repeat (equal rows get places of their own). An empty table gives an empty one. A result whose name the key or
    length has gets underscores before its own.
    """
    # a key or length named like a result keeps its values: results are made under names of their own
    rows = saved(df.select(F.col(f"`{key}`").alias("k"), F.greatest(F.coalesce(F.col(f"`{length}`").cast("bigint"), F.lit(0)), F.lit(0)).alias("n")), "lengths")
    histogram = rows.filter(F.col("n") <= budget).groupBy("n").agg(F.count(F.lit(1))).collect()
    ends = bucket_lengths([(r[0], r[1]) for r in histogram], buckets)
    bucket = F.lit(len(ends))
    padded = F.col("n")
    for i in range(len(ends) - 1, -1, -1):
        bucket = F.when(F.col("n") <= ends[i], F.lit(i)).otherwise(bucket)
        padded = F.when(F.col("n") <= ends[i], F.lit(ends[i]).cast("bigint")).otherwise(padded)
    marked = rows.withColumns({"bucket": bucket, "padded_length": padded})
    placed = numbered(marked, "bucket", ["k", "n"], "slot")
    held = F.greatest(F.floor(F.lit(budget) / F.greatest("padded_length", F.lit(1))), F.lit(1)).cast("bigint")
    results = ["bucket", "padded_length", "batch", "place"]
    names = [fresh(c, [key, length]) for c in results]
    return placed.withColumn("held", held).select(
        F.col("k").alias(key), F.col("n").alias(length), F.col("bucket").alias(names[0]), F.col("padded_length").alias(names[1]),
        F.expr("slot div held").alias(names[2]), F.expr("slot % held").alias(names[3]),
    )


def pack_documents(docs: DataFrame) -> DataFrame:
    return pack(docs.select("doc_id", word_count(F.col("text")).alias("n_tokens")), "doc_id", "n_tokens")


def sql(budget: int = BUDGET, buckets: int = BUCKETS) -> str:
    """The same in SQL, with the plain quadratic recurrence."""
    steps = ["b0 AS (SELECT j, l * r - t AS cost, [l] AS ends FROM cumulated)"]
    for b in range(1, buckets):
        steps.append(f"""b{b} AS (
  SELECT j, min(cost) AS cost, arg_min(ends, (cost, i)) AS ends FROM (
    SELECT c.j, p.j AS i, p.cost + c.l * (c.r - q.r) - (c.t - q.t) AS cost, list_append(p.ends, c.l) AS ends
    FROM cumulated c JOIN b{b - 1} p ON p.j < c.j JOIN cumulated q ON q.j = p.j) GROUP BY j)""")
    last = " UNION ALL ".join(f"SELECT {b} AS b, ends FROM b{b} WHERE j = (SELECT max(j) FROM cumulated)" for b in range(buckets))
    return f"""
WITH docs AS (
  SELECT doc_id, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS n_tokens FROM documents
), histogram AS (SELECT n_tokens AS l, count(*) AS n FROM docs WHERE n_tokens <= {budget} GROUP BY 1),
cumulated AS (
  SELECT row_number() OVER (ORDER BY l) AS j, l, (sum(n) OVER (ORDER BY l))::BIGINT AS r, (sum(n * l) OVER (ORDER BY l))::BIGINT AS t FROM histogram
), {", ".join(steps)},
chosen AS (SELECT ends FROM ({last}) ORDER BY b DESC LIMIT 1),
edges AS (SELECT unnest(ends) AS l, generate_subscripts(ends, 1) - 1 AS bucket FROM chosen),
marked AS (
  SELECT doc_id, n_tokens, CASE WHEN n_tokens > {budget} THEN (SELECT count(*) FROM edges) ELSE (SELECT min(bucket) FROM edges WHERE l >= n_tokens) END AS bucket,
    CASE WHEN n_tokens > {budget} THEN n_tokens ELSE (SELECT min(l) FROM edges WHERE l >= n_tokens) END AS padded_length FROM docs
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3), doc_id NULLS FIRST, n_tokens) - 1 AS slot,
    greatest({budget} // greatest(padded_length, 1), 1) AS held FROM marked
)
SELECT doc_id, n_tokens, bucket::INT AS bucket, padded_length::BIGINT AS padded_length, (slot // held)::BIGINT AS batch, (slot % held)::BIGINT AS place FROM placed
"""
