"""Benchmark decontamination: windows of the benchmark's words as a broadcast hash set, looked up at every word of the documents.

A window whose hash is found is verified against the words themselves. Found windows mark the words they cover; the documents or
only the covered spans can then be removed. Documents take one narrow pass for each block of benchmark windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import LOWER, UPPER, saved, set_aside, share
from tallymark.llm.words import ALPHANUMERIC, hash_words, slices, windows

WIDTH = 10
#: Windows that are broadcast at once (about 40 MB with their words); a larger benchmark is looked up block by block.
BLOCK_WINDOWS = 200_000

_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_LOWERED = bytes.maketrans(UPPER.encode(), LOWER.encode())
_FILTER_BITS = 22

HITS = "array<struct<start:bigint,stop:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode().translate(_LOWERED))


def benchmark_windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(window, width, items): each distinct window of the benchmark's words and the items that hold it; short items are one window."""
    lowered = F.translate(F.col(f"`{text}`"), UPPER, LOWER)
    words = F.expr(r"regexp_extract_all(t, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+', 0)")
    counted = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), lowered.alias("t")).select("item", words.alias("w")).filter(F.size("w") > 0)
    n = F.least(F.size("w"), F.lit(width))
    starts = F.explode(F.sequence(F.lit(1), F.size("w") - n + 1)).alias("at")
    each = counted.select("item", "w", n.alias("width"), starts).select(
        "item", "width", F.array_join(F.slice("w", F.col("at"), F.col("width")), " ").alias("window")
    )
    return each.groupBy("window", "width").agg(F.collect_set("item").alias("items"))


class Index:
    """The windows of one block: their hashes in order, a bit filter before them, and what stands behind each hash."""

    def __init__(self, rows: list[tuple[str, int, list[str]]]):
        self.widths: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.items: dict[tuple[int, int], dict[bytes, list[str]]] = {}
        by_width: dict[int, list] = {}
        for window, width, items in rows:
            by_width.setdefault(width, []).append((window, items))
        for width, some in by_width.items():
            words, _ = hash_words(pa.array([w for w, _ in some]), ALPHANUMERIC)
            hashes = windows(words, width)[::width]
            bits = np.zeros(1 << _FILTER_BITS, bool)
            bits[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.widths[width] = (np.unique(hashes), bits)
            for h, (window, items) in zip(hashes.tolist(), some):
                self.items.setdefault((width, h), {})[window.encode()] = items

    def find(self, texts: pa.Array) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """For each text its number of words, the hit word ranges (merged, in order) and the items found."""
        hashes, first = hash_words(texts, ALPHANUMERIC)
        spans: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        items: list[set[str]] = [set() for _ in range(len(texts))]
        known: dict[int, list[bytes]] = {}
        for width, (wanted, bits) in self.widths.items():
            found = windows(hashes, width)
            at = np.flatnonzero(bits[found >> np.uint64(64 - _FILTER_BITS)])
            at = at[wanted[np.minimum(np.searchsorted(wanted, found[at]), len(wanted) - 1)] == found[at]]
            rows = np.searchsorted(first, at, "right") - 1
            inside = at + width <= first[rows + 1]
            for i, r in zip(at[inside].tolist(), rows[inside].tolist()):
                if r not in known:
                    known = {r: words_of(texts[r].as_py())}
                k = i - int(first[r])
                hit = self.items[width, int(found[i])].get(b" ".join(known[r][k : k + width]))
                if hit is not None:
                    items[r].update(hit)
                    spans[r].append((k, k + width))
        return np.diff(first), [merged(s) for s in spans], items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges in order, those that overlap or touch as one."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _blocks(benchmark: DataFrame, item: str, text: str, width: int) -> Iterator[Index]:
    """The benchmark's windows in blocks of at most BLOCK_WINDOWS, read block by block."""
    found = benchmark_windows(benchmark, item, text, width)
    parts = max(1, -(-found.count() // BLOCK_WINDOWS))
    for p in range(parts):
        mine = found if parts == 1 else found.filter(F.pmod(F.xxhash64("window"), F.lit(parts)) == p)
        yield Index([(r["window"], r["width"], r["items"]) for r in mine.toLocalIterator()])


def mark(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH
) -> DataFrame:
    """`docs` with n_words, hits (ranges of hit words, from 0, merged) and items (their identifiers as sorted strings).

    An item without an identifier marks words but adds no item. A null or empty text, or one without words, has no hits; an item without words is never found. Items of fewer words than
    `width` are one window. Repeated rows get equal results; columns of `docs` named like the results are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_words", "hits", "items")])
    out = docs.withColumns({"n_words": F.lit(0).cast("bigint"), "hits": F.array().cast(HITS), "items": F.array().cast("array<string>")})
    shared = None
    for index in _blocks(benchmark, item, item_text, width):
        if shared is not None:  # no worker holds more than one block
            out = saved(out, "marked")
            shared.unpersist()
        shared = share(spark, index)
        out = _lookup(out, text, shared)
    return out


def _lookup(df: DataFrame, text: str, shared) -> DataFrame:
    fields = df.schema
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def batches(them):
        index = shared.value
        for batch in them:
            for piece in slices(batch, text):
                counts, spans, items = index.find(piece.column(text))
                old_spans, old_items = piece.column("hits").to_pylist(), piece.column("items").to_pylist()
                hits = [merged([(x["start"], x["stop"]) for x in old] + new) if old else new for old, new in zip(old_spans, spans)]
                names = [sorted(set(old) | new) if old or new else [] for old, new in zip(old_items, items)]
                rows = pa.array([[{"start": a, "stop": b} for a, b in h] for h in hits], span)
                columns = {
                    "n_words": pa.array(counts, pa.int64()), "hits": rows, "items": pa.array(names, pa.list_(pa.string())),
                }
                names_in = piece.schema.names
                yield pa.RecordBatch.from_arrays([columns.get(c, piece.column(c)) for c in names_in], names=names_in)

    return df.mapInArrow(batches, fields)


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text: str = "text", **options) -> DataFrame:
    """`docs` without contaminated documents, or (`remove="spans"`) with the hit words cut out of them.

    A cut span reaches from its first word to its last, so what surrounds it stays as it was; a text whose cutting brings another window together is
    looked at again until none is left. Texts without hits are returned unchanged.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    if remove == "documents":
        rows, now = set_aside(docs, ("n_words", "hits", "items"))
        clean = mark(rows, benchmark, now[text], **options).filter(F.size("hits") == 0)
        return clean.select(*[F.col(f"`{n}`").alias(c) for c, n in now.items()])
    found = _blocks(benchmark, options.get("item", "item_id"), options.get("item_text", "text"), options.get("width", WIDTH))
    index = next(found)
    if next(found, None) is not None:
        return _cut_in_rounds(docs, benchmark, text, options)
    shared = share(docs.sparkSession, index)

    def batches(them):
        index = shared.value
        for batch in them:
            texts = batch.column(text).to_pylist()
            while True:
                _, spans, _ = index.find(pa.array(texts, pa.string()))
                if not any(spans):
                    break
                texts = [cut(t, s) if s else t for t, s in zip(texts, spans)]
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == text else batch.column(c) for c in names], names=names)

    return docs.mapInArrow(batches, docs.schema)


def _cut_in_rounds(docs: DataFrame, benchmark: DataFrame, text: str, options: dict) -> DataFrame:
    """Spans of a benchmark of several blocks: what all blocks hit is cut, and texts that were cut are looked at again."""
    rest, done = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text")), None
    kind = rest.schema

    def batches(them):
        for batch in them:
            pairs = zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist())
            texts = pa.array([cut(t, [(x["start"], x["stop"]) for x in hits]) for t, hits in pairs], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts], names=["row", "text"])

    while True:
        marked = saved(mark(rest, benchmark, "text", **options), "spans")
        clean = marked.filter(F.size("hits") == 0).select("row", "text")
        done = clean if done is None else done.union(clean)
        hit = marked.filter(F.size("hits") > 0)
        if hit.isEmpty():
            return done.select(*[(F.col("text") if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
        rest = hit.select("row", "text", "hits").mapInArrow(batches, kind)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the ranges and what stands between the words of one range."""
    data = text.encode()
    places = [m.span() for m in _WORDS.finditer(data.translate(_LOWERED))]
    kept, at = [], 0
    for lo, hi in spans:
        kept.append(data[at : places[lo][0]])
        at = places[hi - 1][1]
    return b"".join([*kept, data[at:]]).decode()


def documents_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for each document."""
    marked = mark(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda s, h: s + h["stop"] - h["start"])
    return marked.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


SQL = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS v
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM item_words WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), doc_windows AS (
  SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS v
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM docs, (SELECT DISTINCT k FROM item_windows) WHERE len(w) >= k)
), found AS (
  SELECT r, k, i, item_id FROM doc_windows JOIN item_windows USING (k, v)
), hit AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + k)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS list FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM found) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit.n, 0)::BIGINT AS n_hit, coalesce(items.n, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""
