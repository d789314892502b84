"""Language identification by hierarchical discrimination: the family first, then one-versus-one linear support vector machines.

Features are the shares of hashed runs of one to three bytes (ASCII letters lower-cased, every other ASCII byte a space). A linear
machine over shares scores a text by the mean of its runs' weights, so texts are scored by whole-array steps over the bytes of a
batch, however long they are. The machines are fitted on a bounded sample, one task for each pair of classes.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import fresh, saved, share
from tallymark.llm.words import column_bytes, slices

FEATURES = 1 << 13
#: Labelled rows of each language that the machines are fitted on, at most.
ROWS_PER_LANGUAGE = 500
ROUNDS = 200
STRENGTH = 1e-3
#: Languages that can be learned, at most: the machines of all pairs are broadcast.
LANGUAGES = 200
UNKNOWN = "und"
#: A letter of any script.
LETTER = r"\p{L}"

#: Families of common languages by ISO code, a fixed table; a language that is not listed is a family of its own.
FAMILIES: dict[str, str] = {
    **dict.fromkeys("en de nl sv da no nb nn is af fy lb yi".split(), "germanic"),
    **dict.fromkeys("fr es it pt ro ca gl oc la".split(), "romance"),
    **dict.fromkeys("ru uk be pl cs sk sl hr sr bs bg mk".split(), "slavic"),
    **dict.fromkeys("hi bn ur pa mr gu ne si fa ps ku".split(), "indo-iranian"),
    **dict.fromkeys("fi et hu".split(), "uralic"),
    **dict.fromkeys("tr az kk uz ky tk".split(), "turkic"),
    **dict.fromkeys("ar he mt am".split(), "semitic"),
    **dict.fromkeys("lv lt".split(), "baltic"),
    **dict.fromkeys("ga cy gd br".split(), "celtic"),
}

_PLAIN = np.full(256, 32, np.uint32)
_PLAIN[128:] = np.arange(128, 256)
_PLAIN[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def _runs(plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers of the runs of one, two and three bytes that begin at each place (the array ends with two spaces)."""
    one, two = plain[:-2], plain[1:-1]
    pairs = one * np.uint32(0x9E3779B1) + two * np.uint32(0x85EBCA77)
    triples = pairs * np.uint32(0xC2B2AE3D) + plain[2:] * np.uint32(0x27D4EB2F) + np.uint32(0x165667B1)
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    return one, (pairs ^ (pairs >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift, (triples ^ (triples >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift


def shares(text: bytes) -> np.ndarray:
    """The feature vector of a text: shares of its runs."""
    plain = _PLAIN[np.frombuffer(b" " + text + b"  ", np.uint8)]
    counts = np.zeros(FEATURES)
    for run in _runs(plain):
        counts += np.bincount(run, minlength=FEATURES)[:FEATURES]
    return counts / counts.sum()


def _svm(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear machine (squared hinge loss, accelerated gradient steps; both classes weigh the same)."""
    scale = 1.0 / np.sqrt(np.maximum(x.mean(axis=0), 1e-6))
    z = (x * scale).astype(np.float32)
    middle = z.mean(axis=0)
    z -= middle
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(np.float32)
    top = np.float32(2.0 * (weight * (z * z).sum(axis=1)).sum() + 2.0 + STRENGTH)
    w, b, pw, pb = np.zeros(z.shape[1], np.float32), np.float32(0), np.zeros(z.shape[1], np.float32), np.float32(0)
    for k in range(ROUNDS):
        slack = np.maximum(0, 1 - y * (z @ pw + pb)).astype(np.float32) * weight * y
        nw = pw + (2 * (z.T @ slack) - STRENGTH * pw) / top
        nb = pb + 2 * slack.sum() / top
        momentum = np.float32(k / (k + 3))
        pw, pb = nw + momentum * (nw - w), nb + momentum * (nb - b)
        w, b = nw, nb
    weights = w.astype(np.float64) * scale
    return weights, float(b - (w * middle).sum())


@dataclass
class Model:
    """Machines between families and, within each, between its languages: (first class, second class, weights, intercept)."""

    families: dict[str, list[str]]
    machines: dict[tuple[str, str], tuple[np.ndarray, float]]

    def _vote(self, classes: list[str], margins: dict[tuple[str, str], np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
        """The class with the most won duels (then the largest sum of margins), and the weakest of its duels as a probability."""
        if len(classes) == 1:
            return np.zeros(n, np.int64), np.ones(n)
        wins, sums, least = (np.zeros((len(classes), n)) for _ in range(3))
        least += np.inf
        for i, j in combinations(range(len(classes)), 2):
            m = margins[classes[i], classes[j]]
            wins[i] += m >= 0
            wins[j] += m < 0
            sums[i] += np.clip(m, -5, 5)
            sums[j] -= np.clip(m, -5, 5)
            least[i], least[j] = np.minimum(least[i], m), np.minimum(least[j], -m)
        best = np.argmax(wins + np.tanh(sums / 100), axis=0)
        return best, 1 / (1 + np.exp(-np.clip(3 * least[best, np.arange(n)], -50, 50)))

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and score of each text, by all of its bytes."""
        margins = {pair: np.zeros(len(texts)) for pair in self.machines}
        data, bounds = column_bytes(texts)
        for k, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if hi - lo > _LONG:
                self._add(margins, data[lo:hi], np.array([0, hi - lo]), k, k + 1)
        lo = 0
        long = np.flatnonzero(np.diff(bounds) > _LONG).tolist()
        for stop in [*long, len(texts)]:
            if stop > lo:
                self._add(margins, data[bounds[lo] : bounds[stop]], bounds[lo : stop + 1] - bounds[lo], lo, stop)
            lo = stop + 1
        names = sorted(self.families)
        n = len(texts)
        family, score = self._vote([f"family {f}" for f in names], margins, n)
        languages, out = [""] * n, score.copy()
        for k, name in enumerate(names):
            members = self.families[name]
            rows = np.flatnonzero(family == k)
            best, inner = self._vote(members, {p: m[rows] for p, m in margins.items() if p[0] in members}, len(rows))
            out[rows] *= inner
            for r, b in zip(rows.tolist(), best.tolist()):
                languages[r] = members[b]
        return languages, out

    def _add(self, margins: dict, data: np.ndarray, bounds: np.ndarray, first: int, stop: int) -> None:
        """Margins of rows first to stop, whose bytes are `data`; each text is read with a space before and two after it."""
        sizes = np.diff(bounds)
        plain = np.full(len(data) + 3 * len(sizes), 32, np.uint32)
        starts = bounds[:-1] + 3 * np.arange(len(sizes))
        plain[np.arange(len(data)) + np.repeat(3 * np.arange(len(sizes)) + 1, sizes)] = _PLAIN[data]
        ends = starts + sizes + 1
        if len(sizes) == 1:
            for lo in range(0, len(plain) - 2, _LONG):
                self._sum(margins, plain[lo : lo + _LONG + 2], np.zeros(1, np.int64), np.array([min(_LONG, len(plain) - 2 - lo)]), first, stop)
        else:
            self._sum(margins, plain, starts, ends, first, stop)
        for (_, intercept), m in zip(self.machines.values(), margins.values()):
            m[first:stop] = m[first:stop] / (3 * (sizes + 1)) + intercept

    def _sum(self, margins, plain, starts, ends, first, stop) -> None:
        one, two, three = _runs(plain)
        for (weights, _), m in zip(self.machines.values(), margins.values()):
            w = weights.astype(np.float32)
            each = w[one]
            each += w[two]
            each += w[three]
            sums = np.concatenate([[0.0], np.cumsum(each, dtype=np.float64)])
            m[first:stop] += sums[ends] - sums[starts]


_LONG = 1 << 20


def sample(df: DataFrame, text: str, lang: str, rows: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """At most `rows` rows (text, lang) of each language: those whose texts have the smallest hashes.

    A first cut by the share of the different texts that is needed keeps the candidates few; the exact cut is made on those.
    """
    known = df.filter(F.col(lang).isNotNull() & F.col(text).rlike(LETTER)).select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    texts = known.groupBy("lang", F.xxhash64("text").alias("hash")).agg(F.lit(1)).groupBy("lang").count()
    counts = {r[0]: r[1] for r in texts.orderBy(F.desc("count"), "lang").limit(LANGUAGES + 1).collect()}
    if len(counts) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    share = F.lit(0.0)
    for name, n in sorted(counts.items()):
        share = F.when(F.col("lang") == name, F.lit(min(1.0, 2.0 * rows / n))).otherwise(share)
    spot = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = known.withColumn("spot", spot).filter(F.col("spot") < share)

    def first(some: pd.DataFrame) -> pd.DataFrame:
        return some.sort_values(["spot", "text"]).drop_duplicates("text").head(rows)[["text", "lang"]]

    # one text that is repeated very often is one row here
    return near.dropDuplicates(["text", "lang"]).groupBy("lang").applyInPandas(first, "text string, lang string")


def fit(df: DataFrame, text: str = "text", lang: str = "lang", families: Mapping[str, str] = FAMILIES, rows: int = ROWS_PER_LANGUAGE) -> Model:
    """Machines learned from the rows of `df` whose `lang` is not null and whose text has a letter; nothing else is read."""
    chosen = saved(sample(df, text, lang, rows), "languages")
    languages = sorted(r[0] for r in chosen.select("lang").distinct().collect())
    grouped: dict[str, list[str]] = {}
    for name in languages:
        grouped.setdefault(families.get(name, name), []).append(name)
    pairs = [(a, b, [a], [b]) for members in grouped.values() for a, b in combinations(members, 2)]
    pairs += [(f"family {f}", f"family {g}", grouped[f], grouped[g]) for f, g in combinations(sorted(grouped), 2)]
    machines: dict[tuple[str, str], tuple[np.ndarray, float]] = {}
    if pairs:
        sides = [F.when(F.col("lang").isin(a), F.lit(1)).when(F.col("lang").isin(b), F.lit(-1)).otherwise(F.lit(0)) for _, _, a, b in pairs]
        tasks = F.explode(F.filter(F.array(*[F.struct(F.lit(i).alias("pair"), s.alias("side")) for i, s in enumerate(sides)]), lambda x: x["side"] != 0))
        spread = chosen.withColumn("task", tasks).select("task.pair", "task.side", "text")

        def machine(some: pd.DataFrame) -> pd.DataFrame:
            some = some.sort_values(["side", "text"])
            x = np.empty((len(some), FEATURES), np.float32)
            for i, t in enumerate(some["text"]):
                x[i] = shares(t.encode())
            w, b = _svm(x, some["side"].to_numpy(np.float32))
            return pd.DataFrame({"pair": [int(some["pair"].iloc[0])], "weights": [w.tolist()], "intercept": [b]})

        for r in spread.groupBy("pair").applyInPandas(machine, "pair int, weights array<double>, intercept double").collect():
            a, b, _, _ = pairs[r["pair"]]
            machines[a, b] = (np.array(r["weights"]), r["intercept"])
    return Model(grouped, dict(sorted(machines.items())))


def predict(df: DataFrame, model: Model, text: str = "text", out: str = "lang_pred", score: str = "score") -> DataFrame:
    """`df` with the predicted language and its score (0 to 1: the weakest won duel between families times that within).

    A null text, or one without a letter of any script, is `und` with score 0, as is every text if no language was learned. Rows are judged one by
    one, so repeated rows get equal results; columns of `df` named like the results are replaced. Rows don't move.
    """
    shared = share(df.sparkSession, model)
    base = df.drop(*[c for c in df.columns if c.lower() in (out.lower(), score.lower())])
    letter = fresh("has_letter", [*base.columns, out, score])
    marked = base.withColumn(letter, F.coalesce(F.col(f"`{text}`").rlike(LETTER), F.lit(False)))
    names_out = [*base.columns, out, score]
    schema = T.StructType([*base.schema.fields, T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType())])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in them:
            for piece in slices(batch, text):
                flags = piece.column(letter).to_numpy(zero_copy_only=False)
                if known.families:
                    names, scores = known.predict(piece.column(text))
                else:
                    names, scores, flags = [UNKNOWN] * len(flags), np.zeros(len(flags)), np.zeros(len(flags), bool)
                columns = [c for n, c in zip(piece.schema.names, piece.columns) if n != letter]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array([n if f else UNKNOWN for n, f in zip(names, flags)], pa.string()), pa.array(np.where(flags, scores, 0.0))],
                    names=names_out,
                )

    return marked.mapInArrow(batches, schema)


def held_out(key: Column) -> Column:
    """Whether a row is kept from learning: crc32 of its key as text is divisible by 5 (a null key counts as an empty text)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 5 == 0


def documents_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document, learned from those not held out."""
    docs = docs.select("doc_id", "text", "lang")
    model = fit(docs.filter(~held_out(F.col("doc_id"))))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
