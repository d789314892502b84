"""Importance resampling towards a target distribution, over hashed runs of words.

A feature's bucket is the CRC-32 of its words modulo the number of buckets. The corpus is counted line by line: separator newlines
cut the texts, each distinct line's features are counted once and taken as often as the line occurs, and runs that go from one line
into the next are counted separately for every text. The logarithm of how much commoner a bucket is in the target than in the corpus
is its gain; a document's weight is the mean gain of its features, and Gumbel noise by a hash of its key makes the best scores a draw
in proportion to the weights.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import LOWER, UPPER, fresh, repeated, saved

#: Bytes of a text that are cut into words at once.
BLOCK_BYTES = 1 << 20
#: Features whose buckets a task remembers at once.
REMEMBERED = 1 << 16

_WORDS = bytes.maketrans(
    UPPER.encode() + bytes(b for b in range(0x80) if not chr(b).isalnum()), LOWER.encode() + b" " * sum(not chr(b).isalnum() for b in range(0x80))
)


@dataclass(frozen=True)
class Sampling:
    """Runs of up to `longest` words in `buckets` buckets; num / den of the documents with `least_words` words are drawn."""

    longest: int = 1
    buckets: int = 10_000
    num: int = 10
    den: int = 100
    least_words: int = 20
    seed: int = 2024


class Buckets(dict):
    """The bucket of each feature, remembered for the features seen last."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        self[feature] = bucket = zlib.crc32(feature) % self.buckets
        return bucket


def _blocks(data: bytes) -> Iterator[bytes]:
    """Pieces of words between spaces of about BLOCK_BYTES; no word is cut."""
    lo = 0
    while len(data) - lo > BLOCK_BYTES:
        hi = data.find(b" ", lo + BLOCK_BYTES)
        if hi < 0:
            break
        yield data[lo:hi]
        lo = hi
    yield data[lo:]


def _runs(words: Sequence[bytes], longest: int, fresh_from: int = 0) -> Iterator[bytes]:
    """Runs of 2 to `longest` words that end at the place `fresh_from` or later."""
    for k in range(2, longest + 1):
        for end in range(max(fresh_from, k - 1), len(words)):
            yield b" ".join(words[end - k + 1 : end + 1])


def features(text: str | None, longest: int) -> Iterator[tuple[int, list[bytes]]]:
    """(words, features) of a text, in blocks of it; line ends are separators like any other."""
    before: list[bytes] = []
    for block in _blocks((text or "").encode().translate(_WORDS)):
        words = block.split()
        found = words
        if longest > 1:
            both = before + words
            found = words + list(_runs(both, longest, len(before)))
            before = both[-(longest - 1) :]
        yield len(words), found


def crossing(text: str | None, longest: int) -> Iterator[bytes]:
    """The features of a text that begin in one line and end in a later one."""
    before: list[bytes] = []
    for line in (text or "").split("\n"):
        data = line.encode().translate(_WORDS)
        head = data.split(maxsplit=longest - 1)[: longest - 1]
        both = before + head
        for k in range(2, longest + 1):
            for end in range(max(len(before), k - 1), len(both)):
                if end - k + 1 < len(before):
                    yield b" ".join(both[end - k + 1 : end + 1])
        tail = data.rsplit(maxsplit=longest - 1)[-(longest - 1) :]
        before = (before + head if len(head) < longest - 1 else tail)[-(longest - 1) :]


def _counted(rows: DataFrame, buckets: int, each) -> DataFrame:
    """(bucket, n) of what `each` (text, occurrences) yields for the rows; a task reports once."""

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in them:
            for text, times in zip(batch.column(0), batch.column(1).to_pylist()):
                for found in each(text.as_py()):
                    if len(found) < 64:
                        for feature in found:
                            total[known[feature]] += times
                    else:
                        total += times * np.bincount(list(map(known.__getitem__, found)), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    return rows.mapInArrow(batches, "bucket int, n bigint")


def bucket_counts(docs: DataFrame, text: str, how: Sampling) -> np.ndarray:
    """How many features of all texts lie in each bucket; at most `buckets` rows reach the driver."""
    column = F.col(f"`{text}`").cast("string")
    lines = docs.select(F.explode(F.split(column, "\n")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("times"))
    counts = _counted(lines, how.buckets, lambda line: (found for _, found in features(line, how.longest)))
    if how.longest > 1:
        whole = docs.select(column, F.lit(1).cast("bigint"))
        counts = counts.unionAll(_counted(whole, how.buckets, lambda t: [list(crossing(t, how.longest))]))
    out = np.zeros(how.buckets, np.int64)
    for r in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier a bucket is in the target, one added to every count."""
    s_all, t_all, more = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([
        math.floor(1000 * math.log((t + 1) * float(s_all + more) / ((s + 1) * float(t_all + more)))) for s, t in zip(corpus.tolist(), target.tolist())
    ], np.int64)


def noise(key: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of SHA-256 of `seed:key`; a null key counts as an empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def scores(docs: DataFrame, target: DataFrame, how: Sampling = Sampling(), key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """`docs` with n_words, n_features, weight and score of each row; columns of `docs` with these names are replaced.

    A null text, or one without words, has no features and weight 0. Repeated rows are scored alike. No row moves: gains are one array
    of `buckets` numbers.
    """
    results = ["n_words", "n_features", "weight", "score"]
    base = docs.drop(*[c for c in docs.columns if c.lower() in results and c not in (key, text)])
    values = gains(bucket_counts(docs, text, how), bucket_counts(target, target_text, how))
    body = fresh("body", base.columns)
    names = [*base.columns, "n_words", "n_features", "weight"]

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Buckets(how.buckets)
        for batch in them:
            words, counts, weights = [], [], []
            for t in batch.column(batch.num_columns - 1):
                n, many, total = 0, 0, 0
                for w, found in features(t.as_py(), how.longest):
                    n, many = n + w, many + len(found)
                    total += int(values[list(map(known.__getitem__, found))].sum()) if found else 0
                words.append(n)
                counts.append(many)
                weights.append(total // many if many else 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *[pa.array(c, pa.int64()) for c in (words, counts, weights)]], names=names)

    fields = T.StructType([*base.schema.fields, *[T.StructField(c, T.LongType()) for c in names[-3:]]])
    rows = base.select(*[F.col(f"`{c}`") for c in base.columns], F.col(f"`{text}`").cast("string").alias(body)).mapInArrow(batches, fields)
    return rows.withColumn("score", F.col("weight") + noise(F.col(f"`{key}`"), how.seed))


def ranked(scored: DataFrame, how: Sampling, key: str = "doc_id") -> DataFrame:
    """`scored` with the rank (from 1, null if not drawn) of each row: highest scores first, ties to the smaller key, null keys last.

    A histogram of the scores (whole numbers of a bounded range, some ten thousand) gives every score its first rank, so only rows of one
    score are ordered together; equal rows are one row until their ranks are written out.
    """
    scored = saved(scored, "scores")
    may = scored.filter(F.col("n_words") >= how.least_words)
    counts = may.groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    before = fresh("before", scored.columns)
    starts = counts.select("score", (F.sum("n").over(Window.orderBy(F.desc("score"))) - F.col("n")).alias(before))
    draw = how.num * may.count() // how.den
    starts = saved(starts.filter(F.col(before) < draw), "starts")
    near = scored.join(F.broadcast(starts), "score", "left").withColumn(before, F.when(F.col("n_words") >= how.least_words, F.col(before)))
    copies, first = fresh("copies", near.columns), fresh("first", near.columns)
    some = near.filter(F.col(before).isNotNull()).groupBy(*near.columns).agg(F.count(F.lit(1)).alias(copies))
    others = [c for c in scored.columns if c not in ("score", key)]
    order = Window.partitionBy("score").orderBy(F.col(f"`{key}`").asc_nulls_last(), *[f"`{c}`" for c in others])
    placed = some.withColumn(first, F.col(before) + F.sum(copies).over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col(copies) + 1)
    drawn = repeated(placed, copies, first, "rank").withColumn("rank", F.when(F.col("rank") <= draw, F.col("rank")))
    rest = near.filter(F.col(before).isNull()).withColumn("rank", F.lit(None).cast("bigint"))
    names = [*[F.col(f"`{c}`") for c in scored.columns], F.col("rank").cast("bigint").alias("rank")]
    return drawn.select(*names).unionAll(rest.select(*names))


def resample(docs: DataFrame, target: DataFrame, how: Sampling = Sampling(), key: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """The drawn rows of `docs`, whole and unchanged: num / den (floored) of those with enough words."""
    row, own = "row", F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    packed = docs.select(own.alias(row), F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text"))
    scored = scores(packed, target, how, "key", "text", target_text).drop("text")
    return ranked(scored, how, "key").filter("rank is not null").select(f"{row}.*")


def documents_draw(docs: DataFrame, benchmark: DataFrame, how: Sampling = Sampling()) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    scored = scores(docs.select("doc_id", "text"), benchmark, how).drop("text")
    return ranked(scored, how).select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), source_words AS (SELECT r, unnest(w) AS word FROM docs),
source_counts AS (SELECT r, word, count(*) AS n FROM source_words GROUP BY ALL),
target_counts AS (
  SELECT word, count(*) AS n FROM (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark)
  GROUP BY 1
), vocabulary AS (SELECT DISTINCT word FROM (SELECT word FROM source_counts UNION ALL SELECT word FROM target_counts)),
spelled AS (SELECT word, list_transform(regexp_extract_all(hex(encode(word)), '..'), lambda x: ('0x' || x)::BIGINT) AS b FROM vocabulary),
buckets AS (
  SELECT word, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM spelled, crc_table
), s AS (SELECT bucket, sum(n) AS n FROM source_counts JOIN buckets USING (word) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS n FROM target_counts JOIN buckets USING (word) GROUP BY 1),
gain AS (
  SELECT b AS bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g
  FROM range(10000) x(b) LEFT JOIN s ON s.bucket = b LEFT JOIN t ON t.bucket = b
), weighed AS (
  SELECT r, sum(n * g)::BIGINT AS total FROM source_counts JOIN buckets USING (word) JOIN gain USING (bucket) GROUP BY 1
), scored AS (
  SELECT r, doc_id, len(w)::BIGINT AS n_features,
    CASE WHEN len(w) = 0 THEN 0 ELSE (total - ((total % len(w)) + len(w)) % len(w)) // len(w) END::BIGINT AS weight,
    floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
  FROM docs LEFT JOIN weighed USING (r)
), placed AS (
  SELECT r, row_number() OVER (ORDER BY weight + noise DESC, doc_id NULLS LAST, n_features, weight) AS rank FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, weight + noise AS score,
  CASE WHEN rank <= (SELECT 10 * count(*) // 100 FROM placed) THEN rank END AS rank
FROM scored LEFT JOIN placed USING (r)
"""
