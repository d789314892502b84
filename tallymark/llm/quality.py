"""Quality classifier by hierarchical empirical Bayes.

A document's own evidence is the log likelihood ratio that a small logistic model gives for being bad (of low quality or toxic).
It is added to the log odds of its site: labelled outcomes counted by host and path, sparse paths shrunk towards their host and
sparse hosts towards the global rate.

The model is fitted on a bounded sample of labelled rows; the outcomes of sites are counted over all of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import fresh, joined_small, saved, share
from tallymark.llm.shrinkage import posteriors
from tallymark.llm.words import ALPHANUMERIC, column_bytes, hash_words, mix, slices

#: Labelled rows that the logistic model is fitted on, at most.
SAMPLE = 20_000
#: Features of the model, at most, and how many deviations a feature's bad rate must lie from the mean.
CHOSEN, DEVIATIONS = 768, 4.0
BITS = 18
BINS = 16
SHAPES = ("upper", "symbols", "repeated", "length", "spaces")
ROUNDS = 30
#: Ridge penalty of a weight, in rows.
PENALTY = 0.5
RESULTS = ("evidence", "site_outcomes", "site_rate", "bad_probability", "keep")
#: Rows that a Newton step takes at once.
CHUNK = 1024

_SYMBOLS = np.zeros(256, np.uint64)
_marks = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
_SYMBOLS[_marks] = mix(np.array(_marks, np.uint64))
_UPPER, _LOWER, _MARK, _SPACE = (np.zeros(256, bool) for _ in range(4))
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER[ord("a") : ord("z") + 1] = True
_MARK[_marks] = True
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _counts(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds])


def _bin(share: np.ndarray) -> np.ndarray:
    return np.clip((share * BINS).astype(np.int64), 0, BINS - 1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of all words, runs of symbols and shapes of each text, with repeats; features are below 2^BITS + shapes."""
    rows, found = [], []
    repeated = np.zeros(len(texts))
    for letters, salt in ((ALPHANUMERIC, 1), (_SYMBOLS, 2)):
        hashes, first = hash_words(texts, letters)
        sizes = np.diff(first)
        row = np.repeat(np.arange(len(texts)), sizes)
        rows.append(row)
        found.append((mix(hashes + np.uint64(salt)) >> np.uint64(64 - BITS)).astype(np.int64))
        if salt == 1 and len(hashes):
            _, at = np.unique(hashes ^ mix(row.astype(np.uint64)), return_index=True)
            repeated = 1 - np.bincount(row[at], minlength=len(texts)) / np.maximum(sizes, 1)
            # longer texts repeat more of their words in any case
            repeated = repeated * (sizes > 20)
    data, bounds = column_bytes(texts)
    size = np.maximum(np.diff(bounds), 1)
    upper, lower = _counts(_UPPER[data], bounds), _counts(_LOWER[data], bounds)
    shapes = (
        _bin(upper / np.maximum(upper + lower, 1)), _bin(_counts(_MARK[data], bounds) / size * 4), _bin(repeated),
        np.clip(np.log2(size).astype(np.int64), 0, BINS - 1), _bin(_counts(_SPACE[data], bounds) / size * 2),
    )
    for k, shape in enumerate(shapes):
        rows.append(np.arange(len(texts)))
        found.append((1 << BITS) + k * BINS + shape)
    return np.concatenate(rows), np.concatenate(found)


@dataclass
class Model:
    """Weights of the chosen features, and the log odds (intercept less those of the sample's bad rate)."""

    chosen: np.ndarray
    weights: np.ndarray
    offset: float

    def evidence(self, texts: pa.Array) -> np.ndarray:
        out = np.full(len(texts), self.offset)
        if len(self.chosen) == 0:
            return out
        place = np.full((1 << BITS) + len(SHAPES) * BINS, -1, np.int32)
        place[self.chosen] = np.arange(len(self.chosen))
        rows, found = features(texts)
        at = place[found]
        kept = np.flatnonzero(at >= 0)
        pairs = np.unique(rows[kept] * len(self.chosen) + at[kept])
        return out + np.bincount(pairs // len(self.chosen), self.weights[pairs % len(self.chosen)], len(texts))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic model with a small ridge penalty, by damped Newton steps.

    Sums go over chunks of rows, so no copy of the whole matrix is made.
    """
    n, width = x.shape
    ridge = np.full(width + 1, PENALTY)
    ridge[-1] = 1e-9
    w = np.zeros(width + 1)

    def chunks() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for lo in range(0, n, CHUNK):
            part = np.ones((min(CHUNK, n - lo), width + 1))
            part[:, :-1] = x[lo : lo + CHUNK]
            yield part, y[lo : lo + CHUNK]

    def loss(w: np.ndarray) -> float:
        rows = sum(float(np.logaddexp(0, np.where(some > 0, -1, 1) * (part @ w)).sum()) for part, some in chunks())
        return rows + 0.5 * float((ridge * w * w).sum())

    now = loss(w)
    for _ in range(ROUNDS):
        bend, slope = np.diag(ridge + 1e-6), -ridge * w
        for part, some in chunks():
            p = 1 / (1 + np.exp(-np.clip(part @ w, -30, 30)))
            bend += (part * (p * (1 - p))[:, None]).T @ part
            slope += part.T @ (some - p)
        step = np.linalg.solve(bend, slope)
        size = 1.0
        while size > 1e-3 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        before, now = now, loss(w)
        if before - now < 1e-6 * max(now, 1.0):
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, outcomes: DataFrame, key: str, text: str, rows: int = SAMPLE) -> Model:
    """A model from at most `rows` rows of `outcomes` (`key`, `is_bad`), those whose keys have the smallest hashes."""
    chosen = outcomes.orderBy(F.xxhash64(key), key).limit(rows)
    width = (1 << BITS) + len(SHAPES) * BINS

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for piece in slices(batch, text):
                r, f = features(piece.column(text))
                pairs = np.unique(r * width + f)
                cuts = np.searchsorted(pairs // width, np.arange(piece.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(pairs % width, pa.int32()))
                yield pa.RecordBatch.from_arrays([piece.column("is_bad"), lists], names=["is_bad", "found"])

    known = docs.select(key, text).join(F.broadcast(chosen), key).select(text, "is_bad")
    # copies of one text say no more than one
    sets = saved(known.mapInArrow(batches, "is_bad boolean, found array<int>").dropDuplicates(), "features")
    n, bad = sets.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_bad").cast("int")), F.lit(0))).first()
    if bad == 0 or bad == n:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    rate = bad / n
    # 2 added to the variance keeps features of a few rows out
    apart = (F.sum(F.col("is_bad").cast("double")) - F.count(F.lit(1)) * rate) / F.sqrt(F.count(F.lit(1)) * rate * (1 - rate) + 2)
    strong = sets.select(F.explode("found").alias("feature"), "is_bad").groupBy("feature").agg(F.abs(apart).alias("apart"))
    best = [r[0] for r in strong.filter(F.col("apart") >= DEVIATIONS).orderBy(F.desc("apart"), "feature").limit(CHOSEN).collect()]
    if not best:
        return Model(np.zeros(0, np.int64), np.zeros(0), 0.0)
    features_in = np.sort(np.array(best))

    def train(some: pd.DataFrame) -> pd.DataFrame:
        x = np.zeros((len(some), len(features_in)), np.int8)
        for i, found in enumerate(some["found"]):
            x[i, np.flatnonzero(np.isin(features_in, found))] = 1
        w, b = _logistic(x, some["is_bad"].to_numpy(np.float32))
        return pd.DataFrame({"weights": [w.tolist()], "intercept": [b]})

    # the sample is bounded, so is the one task that fits it; its rows come in a fixed order
    small = sets.select("is_bad", F.array_sort(F.array_intersect("found", F.array(*[F.lit(int(f)) for f in best]))).alias("found"))
    trained = small.orderBy("found", "is_bad").coalesce(1).groupBy().applyInPandas(train, "weights array<double>, intercept double").first()
    return Model(features_in, np.array(trained["weights"]), trained["intercept"] - float(np.log(rate / (1 - rate))))


def site(source: Column) -> tuple[Column, Column]:
    """(host, path) of a source: what stands before the first slash (after a scheme), and that with the first step of the path."""
    plain = F.regexp_replace(F.coalesce(source, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    return F.substring_index(plain, "/", 1), F.substring_index(F.regexp_replace(plain, "[?#].*$", ""), "/", 2)


def document_outcomes(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, is_bad): bad if any label of the document says low quality or toxic; labels without a key or value are left out."""
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    known = labels.filter(F.col(key).isNotNull() & (F.col("quality").isNotNull() | F.col("toxic").isNotNull()))
    return known.select(key, bad.alias("is_bad")).groupBy(key).agg(F.max("is_bad").alias("is_bad"))


def classify(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", threshold: float = 0.5
) -> DataFrame:
    """`docs` with evidence, site_outcomes, site_rate, bad_probability and keep (bad_probability under `threshold`).

    A null or empty text has the evidence of its shape (an empty one); a null source is a site without name. Without labels, or with
    labels of one kind, the evidence is 0 and the rate near the global one. Repeated rows are judged alike; columns of `docs`
    named like the results are replaced. No text is shuffled unless there are more than 100,000 sites.
    """
    outcomes = saved(document_outcomes(labels, key), "outcomes")
    model = share(docs.sparkSession, fit(docs, outcomes, key, text))
    base = docs.drop(*[c for c in docs.columns if c.lower() in RESULTS])
    host, path = fresh("host", base.columns), fresh("path", base.columns)
    host_of, path_of = site(F.col(f"`{source}`"))
    counted = docs.select(key, host_of.alias(host), path_of.alias(path)).join(outcomes, key, "left").groupBy(host, path).agg(
        F.count("is_bad").alias("n"), F.coalesce(F.sum(F.col("is_bad").cast("bigint")), F.lit(0)).alias("bad")
    )
    sites = posteriors(saved(counted, "sites"), [host, path])
    names = [*base.columns, "evidence"]
    schema = T.StructType([*base.schema.fields, T.StructField("evidence", T.DoubleType())])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in them:
            for piece in slices(batch, text):
                scores = model.value.evidence(piece.column(text))
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.array(scores)], names=names)

    scored = base.mapInArrow(batches, schema).withColumns({host: host_of, path: path_of})
    rates = sites.select(host, path, F.col("n").alias("site_outcomes"), (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("site_rate"))
    judged = joined_small(scored, rates, [host, path])
    odds = F.col("evidence") + F.log(F.col("site_rate") / (1 - F.col("site_rate")))
    return judged.withColumn("bad_probability", 1 / (1 + F.exp(-odds))).withColumn("keep", F.col("bad_probability") < threshold).select(
        *base.columns, *RESULTS
    )


def documents_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    judged = classify(docs.select("doc_id", "text", "source"), labels)
    return judged.select("doc_id", F.round("evidence", 6).alias("evidence"), "site_outcomes", F.round("site_rate", 6).alias("site_rate"), F.round("bad_probability", 6).alias("bad_probability"), "keep")
