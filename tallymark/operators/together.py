"""One statistics fit for all stages of a feature pipeline.

Fitted one after the other, the stages of ``features.route`` read the training rows anew for every
median, mode, range and category list. ``FeaturePipeline`` asks first what all of them need:

* one pass counts rows, present numbers and categories (modes and category lists),
* one exact fit reads the order statistics of the raw columns, for medians and ranges at once,
* a power transform's likelihood passes stay as they are.

Filling gaps puts copies of the median in the middle of the order, and a power transform keeps the
order, so the ranks of a filled or transformed column are ranks of its raw column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.columns import quoted, yeo_johnson
from tallymark.operators import features as feats
from tallymark.operators.ordering import local_frame, quantile_values


@dataclass(frozen=True)
class _Origin:
    """Where a working column comes from: its raw column, whether gaps are filled, its power stage."""

    raw: str
    filled: bool = False
    power: Estimator | None = None


@dataclass
class _Asked:
    """What the stages need of the raw columns; ``origins`` are told per stage (by its uid)."""

    numbers: dict[str, list[float]]  # raw column -> quantiles wanted of its (filled) values
    texts: dict[str, bool]  # raw column -> whether all its categories are wanted
    origins: dict[str, list[_Origin]]


def _asked(stages: Sequence) -> _Asked:
    """Follow the columns through the stages, as far as every stage is a known one."""
    asked, now = _Asked({}, {}, {}), {}
    for stage in stages:
        if isinstance(stage, (feats.MedianImputer, feats.YeoJohnson, feats.RobustScale, feats.ModeImputer)):
            pairs = stage.pairs()
        elif isinstance(stage, StringIndexer):
            pairs = list(zip(stage.getInputCols(), stage.getOutputCols(), strict=True)) if stage.isSet("inputCols") else []
        elif isinstance(stage, OneHotEncoder):
            continue
        else:
            break
        origins = [now.get(c, _Origin(c)) for c, _ in pairs]
        known = all(origins)
        text = isinstance(stage, (feats.ModeImputer, StringIndexer))
        if isinstance(stage, (feats.MedianImputer, feats.ModeImputer)):
            known = known and not any(o.filled or o.power for o in origins)
        elif isinstance(stage, feats.YeoJohnson):
            known = known and not any(o.power for o in origins)
        elif isinstance(stage, StringIndexer):
            plain = stage.getStringOrderType() == "alphabetAsc" and stage.getHandleInvalid() == "keep"
            known = known and plain and bool(pairs)
        if known and any(o.raw in (asked.numbers if text else asked.texts) for o in origins):
            known = False
        if known:
            asked.origins[stage.uid] = origins
            for o in origins:
                if text:
                    asked.texts[o.raw] = asked.texts.get(o.raw, False) or isinstance(stage, StringIndexer)
                else:
                    wanted = asked.numbers.setdefault(o.raw, [])
                    if isinstance(stage, feats.RobustScale):
                        wanted += [stage.getOrDefault(stage.lower), 0.5, stage.getOrDefault(stage.upper)]
        for (_, out), o in zip(pairs, origins, strict=True):
            if not known or isinstance(stage, (feats.RobustScale, StringIndexer)):
                now[out] = None
            elif isinstance(stage, feats.YeoJohnson):
                now[out] = replace(o, power=stage)
            else:
                now[out] = replace(o, filled=True)
    return asked


def _present(c: str):
    x = F.col(quoted(c)).cast("double")
    return x.isNotNull() & ~F.isnan(x)


def _counts(df: DataFrame, numbers: Sequence[str], texts: dict[str, bool]):
    """Rows, present numbers per column, and per text column its mode and (if wanted) its categories.

    All in one pass; equal categories are counted map-side. A category list is as long as the one
    that the indexer keeps.
    """
    cells = [F.struct(F.lit(-1).alias("j"), F.lit(None).cast("string").alias("v"))]
    for j, c in enumerate(texts):
        cells.append(F.struct(F.lit(j).alias("j"), F.col(quoted(c)).cast("string").alias("v")))
    flags = [_present(c).alias(f"p{i}") for i, c in enumerate(numbers)]
    long = df.select(*flags, F.explode(F.array(*cells)).alias("e")).select(*[f"p{i}" for i in range(len(numbers))], "e.*")
    here = [F.count(F.when((F.col("j") == -1) & F.col(f"p{i}"), 1)).alias(f"n{i}") for i in range(len(numbers))]
    counted = long.groupBy("j", "v").agg(F.count(F.lit(1)).alias("n"), *here)
    listed = F.lit(False) if not any(texts.values()) else F.col("j").isin([j for j, c in enumerate(texts) if texts[c]])
    told = F.col("v").isNotNull()
    found = {
        r["j"]: r
        for r in counted.groupBy("j").agg(
            F.sum("n").alias("rows"),
            F.min_by(F.when(told, F.col("v")), F.when(told, F.struct(-F.col("n"), F.col("v")))).alias("mode"),
            F.collect_list(F.when(listed, F.col("v"))).alias("categories"),
            *[F.max(f"n{i}").alias(f"n{i}") for i in range(len(numbers))],
        ).collect()
    }
    whole = found.get(-1)
    present = {c: whole[f"n{i}"] if whole else 0 for i, c in enumerate(numbers)}
    modes = {c: found[j]["mode"] if j in found else None for j, c in enumerate(texts)}
    lists = {c: sorted(found[j]["categories"] if j in found else []) for j, c in enumerate(texts)}
    return (whole["rows"] if whole else 0), present, modes, lists


def _ranks(prob: float, n: int) -> tuple[int, int, float]:
    """The two neighbouring 0-based ranks of a quantile among ``n`` values, and the way between them."""
    pos = prob * (n - 1)
    low = min(max(math.floor(pos), 0), n - 1)
    return low, min(low + 1, n - 1), pos - low


class _Learned:
    """The answers to ``_Asked``, read from the raw rows."""

    def __init__(self, df: DataFrame, asked: _Asked):
        self.spark, numbers = df.sparkSession, list(asked.numbers)
        self.total, self.present, self.modes, self.lists = _counts(df, numbers, asked.texts)
        wanted = {c: sorted(self._raw_ranks(c, asked)) for c in numbers if self.present[c]}
        width = max((len(w) for w in wanted.values()), default=0)
        probs = []
        for c, ranks in wanted.items():
            last = max(self.present[c] - 1, 1)
            probs.append([r / last for r in ranks] + [0.0] * (width - len(ranks)))
        found = quantile_values(df, list(wanted), probs, self.total) if wanted else {}
        self.at = {c: dict(zip(ranks, found[c])) for c, ranks in wanted.items()}

    def _raw_ranks(self, c: str, asked: _Asked) -> set[int]:
        """Ranks of the raw column that any stage reads: of the median, and of the quantiles with gaps left out or filled."""
        n = self.present[c]
        out = set(_ranks(0.5, n)[:2])
        for q in asked.numbers[c]:
            for size in {n, self.total}:
                out |= {r for r in map(lambda r: self._place(r, n, size), _ranks(q, size)[:2]) if r is not None}
        return out

    @staticmethod
    def _place(rank: int, n: int, size: int) -> int | None:
        """The raw rank of a rank among ``size`` values, of which all but ``n`` are copies of the median; None for a copy."""
        middle, copies = (n - 1) // 2, size - n
        if rank <= middle:
            return rank
        return rank - copies if rank > middle + copies else None

    def median(self, c: str) -> float:
        low, high, part = _ranks(0.5, self.present[c])
        a, b = self.at[c][low], self.at[c][high]
        return a + (b - a) * part

    def neighbours(self, o: _Origin, prob: float) -> tuple[float, float, float]:
        """The raw values on both sides of a quantile of a (filled) column, and the way between them."""
        n = self.present[o.raw]
        size = self.total if o.filled else n
        low, high, part = _ranks(prob, size)
        ends = [self._place(r, n, size) for r in (low, high)]
        a, b = (self.median(o.raw) if r is None else self.at[o.raw][r] for r in ends)
        return a, b, part


def _scale_model(stage, origins: Sequence[_Origin], learned: _Learned, lambdas: dict):
    probs = [stage.getOrDefault(stage.lower), 0.5, stage.getOrDefault(stage.upper)]
    near = [[learned.neighbours(o, p) for p in probs] for o in origins]
    rows = [
        {"i": i, "lam": lambdas.get((o.power.uid, o.raw)) if o.power else None, "k": k, "x": x}
        for i, o in enumerate(origins) for k, x in enumerate(v for a, b, _ in near[i] for v in (a, b))
    ]
    schema, ends = T.StructType.fromDDL("i int, lam double, k int, x double"), {}
    for lam in {r["lam"] for r in rows}:
        frame = local_frame(learned.spark, [r for r in rows if r["lam"] == lam], schema)
        shown = frame if lam is None else frame.withColumn("x", yeo_johnson("x", lam))
        ends |= {(r["i"], r["k"]): r["x"] for r in shown.collect()}
    q = [
        [ends[i, 2 * j] + (ends[i, 2 * j + 1] - ends[i, 2 * j]) * near[i][j][2] for j in range(3)]
        for i in range(len(origins))
    ]
    model = feats.RobustScaleModel(*map(list, zip(*stage.pairs())))
    return model._set(centers=[v[1] for v in q], scales=[(v[2] - v[0]) or 1.0 for v in q])


def _indexers(stage: StringIndexer, origins: Sequence[_Origin], learned: _Learned) -> list[StringIndexerModel]:
    """One indexer a column: a model of several columns wants category lists of one length."""
    return [
        StringIndexerModel.from_arrays_of_labels([learned.lists[o.raw]], [c], [out], stage.getHandleInvalid())
        for o, c, out in zip(origins, stage.getInputCols(), stage.getOutputCols(), strict=True)
    ]


def _need(stage, origins: Sequence[_Origin], what: str, empty) -> None:
    missing = [c for (c, _), o in zip(stage.pairs(), origins, strict=True) if empty(o.raw)]
    if missing:
        raise ValueError(f"no value to learn a {what} from in {missing}")


class FeaturePipeline(Pipeline):
    """A ``Pipeline`` whose feature stages learn from shared passes; the fitted model is an ordinary one.

    Leading transformers are applied first. Stages that are not known, and all stages behind one,
    are fitted one after the other as in a plain pipeline, and so are stages on columns that
    another known stage made in a way that the raw ranks do not tell (a second power, a scaled
    column). Missing (null or NaN) numbers are left out of every statistic; a column without any
    value raises, as the single stages do.
    """

    def _fit(self, df: DataFrame) -> PipelineModel:
        stages = self.getStages()
        lead = next((i for i, s in enumerate(stages) if not isinstance(s, Transformer)), len(stages))
        rows = df
        for stage in stages[:lead]:
            rows = stage.transform(rows)
        made, asked = list(stages[:lead]), _asked(stages[lead:])
        learned = _Learned(rows, asked) if asked.origins else None
        lambdas: dict[tuple[str, str], float] = {}
        for stage in stages[lead:]:
            origins = asked.origins.get(stage.uid)
            if origins and isinstance(stage, StringIndexer):
                models = _indexers(stage, origins, learned)
            else:
                models = [self._model(stage, origins, learned, lambdas, rows)]
            for model in models:
                made.append(model)
                rows = model.transform(rows)
        return PipelineModel(made)

    @staticmethod
    def _model(stage, origins, learned: _Learned | None, lambdas: dict, rows: DataFrame):
        if isinstance(stage, Transformer):
            return stage
        if origins is None:
            return stage.fit(rows)
        if isinstance(stage, feats.MedianImputer):
            _need(stage, origins, "median", lambda c: not learned.present[c])
            model = feats.MedianImputerModel(*map(list, zip(*stage.pairs())))
            return model._set(medians=[learned.median(o.raw) for o in origins])
        if isinstance(stage, feats.YeoJohnson):
            model = stage.fit(rows)
            lambdas.update({(stage.uid, o.raw): lam for o, lam in zip(origins, model.getOrDefault(model.lambdas), strict=True)})
            return model
        if isinstance(stage, feats.RobustScale):
            _need(stage, origins, "scale", lambda c: not learned.present[c])
            return _scale_model(stage, origins, learned, lambdas)
        if isinstance(stage, feats.ModeImputer):
            _need(stage, origins, "mode", lambda c: learned.modes[c] is None)
            model = feats.ModeImputerModel(*map(list, zip(*stage.pairs())))
            return model._set(modes=[learned.modes[o.raw] for o in origins])
        raise TypeError(f"a stage that is followed but not fitted: {stage}")
