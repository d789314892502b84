"""Fitted feature stages for ``pyspark.ml`` pipelines.

Every stage learns from the frame given to ``fit`` only and keeps what it learned in Params, so a
fitted pipeline saves and loads like a built-in one. Applying a stage is column arithmetic.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import (
    Interaction,
    OneHotEncoder,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.functions.columns import quoted, safe_ratio, yeo_johnson
from tallymark.operators.ordering import local_frame, most_frequent, quantile_values
from tallymark.spec import TableSpec

LAMBDA_POINTS = 13
LAMBDA_LIMIT = 64.0


class _Columns(Params):
    """Input columns and the columns they are written to (the same ones unless named)."""

    inputs = Param(Params._dummy(), "inputs", "input columns", TypeConverters.toListString)
    outputs = Param(Params._dummy(), "outputs", "output columns", TypeConverters.toListString)

    def pairs(self) -> list[tuple[str, str]]:
        ins = self.getOrDefault(self.inputs)
        outs = self.getOrDefault(self.outputs) if self.isSet(self.outputs) else ins
        return list(zip(ins, outs, strict=True))

    def _columns(self, inputs, outputs):
        if inputs is not None:
            self._set(inputs=list(inputs))
        if outputs is not None:
            self._set(outputs=list(outputs))


class _Stage(_Columns, DefaultParamsReadable, DefaultParamsWritable):
    pass


def _write(df: DataFrame, made: dict) -> DataFrame:
    return df.withColumns(made) if made else df


class RatioFeatures(Transformer, _Stage):
    """New columns numerator / denominator; a zero denominator gives a missing value."""

    numerators = Param(Params._dummy(), "numerators", "numerators", TypeConverters.toListString)
    denominators = Param(
        Params._dummy(), "denominators", "denominators", TypeConverters.toListString
    )

    def __init__(self, ratios: Sequence[tuple[str, str, str]] | None = None):
        super().__init__()
        if ratios is not None:
            self._columns([r[0] for r in ratios], None)
            self._set(numerators=[r[1] for r in ratios], denominators=[r[2] for r in ratios])

    def output_names(self) -> list[str]:
        return [out for _, out in self.pairs()]

    def _transform(self, df: DataFrame) -> DataFrame:
        parts = zip(
            self.output_names(),
            self.getOrDefault(self.numerators),
            self.getOrDefault(self.denominators),
            strict=True,
        )
        return _write(df, {out: safe_ratio(num, den) for out, num, den in parts})


class DropColumns(Transformer, _Stage):
    """Remove intermediate columns."""

    def __init__(self, inputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, None)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.inputs))


class MedianImputer(Estimator, _Stage):
    """Fill missing numbers with the interpolated median of the column."""

    def __init__(self, inputs: Sequence[str] | None = None, outputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, outputs)

    def _fit(self, df: DataFrame) -> MedianImputerModel:
        ins = self.getOrDefault(self.inputs)
        middle = quantile_values(df, ins, [0.5])
        empty = [c for c in ins if middle[c][0] is None]
        if empty:
            raise ValueError(f"no value to learn a median from in {empty}")
        model = MedianImputerModel(*map(list, zip(*self.pairs())))
        return model._set(medians=[middle[c][0] for c in ins])


class MedianImputerModel(Model, _Stage):
    medians = Param(Params._dummy(), "medians", "learned medians", TypeConverters.toListFloat)

    def __init__(self, inputs: Sequence[str] | None = None, outputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, outputs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = zip(self.pairs(), self.getOrDefault(self.medians), strict=True)
        null = F.lit(None).cast("double")
        return _write(
            df,
            {
                out: F.coalesce(F.nanvl(F.col(c).cast("double"), null), F.lit(m))
                for (c, out), m in fill
            },
        )


class ModeImputer(Estimator, _Stage):
    """Fill missing categories with the most frequent one, the smallest on ties."""

    def __init__(self, inputs: Sequence[str] | None = None, outputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, outputs)

    def _fit(self, df: DataFrame) -> ModeImputerModel:
        ins = self.getOrDefault(self.inputs)
        texts = df.select(*[F.col(c).cast("string").alias(c) for c in ins])
        found = {r["column"]: r["value"] for r in most_frequent(texts, ins).collect()}
        empty = [c for c in ins if c not in found]
        if empty:
            raise ValueError(f"no value to learn a mode from in {empty}")
        model = ModeImputerModel(*map(list, zip(*self.pairs())))
        return model._set(modes=[found[c] for c in ins])


class ModeImputerModel(Model, _Stage):
    modes = Param(Params._dummy(), "modes", "learned modes", TypeConverters.toListString)

    def __init__(self, inputs: Sequence[str] | None = None, outputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, outputs)

    def _transform(self, df: DataFrame) -> DataFrame:
        fill = zip(self.pairs(), self.getOrDefault(self.modes), strict=True)
        return _write(
            df, {out: F.coalesce(F.col(c).cast("string"), F.lit(m)) for (c, out), m in fill}
        )


class RobustScale(Estimator, _Stage):
    """(x - median) / interquartile range; a range of zero divides by one."""

    lower = Param(Params._dummy(), "lower", "lower quantile", TypeConverters.toFloat)
    upper = Param(Params._dummy(), "upper", "upper quantile", TypeConverters.toFloat)

    def __init__(
        self,
        inputs: Sequence[str] | None = None,
        outputs: Sequence[str] | None = None,
        lower: float = 0.25,
        upper: float = 0.75,
    ):
        super().__init__()
        self._setDefault(lower=0.25, upper=0.75)
        self._columns(inputs, outputs)
        self._set(lower=lower, upper=upper)

    def _fit(self, df: DataFrame) -> RobustScaleModel:
        ins = self.getOrDefault(self.inputs)
        probs = [self.getOrDefault(self.lower), 0.5, self.getOrDefault(self.upper)]
        q = quantile_values(df, ins, probs)
        empty = [c for c in ins if q[c][1] is None]
        if empty:
            raise ValueError(f"no value to learn a scale from in {empty}")
        model = RobustScaleModel(*map(list, zip(*self.pairs())))
        return model._set(
            centers=[q[c][1] for c in ins], scales=[(q[c][2] - q[c][0]) or 1.0 for c in ins]
        )


class RobustScaleModel(Model, _Stage):
    centers = Param(Params._dummy(), "centers", "learned medians", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "learned ranges", TypeConverters.toListFloat)

    def __init__(self, inputs: Sequence[str] | None = None, outputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, outputs)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = zip(
            self.pairs(), self.getOrDefault(self.centers), self.getOrDefault(self.scales), strict=True
        )
        return _write(
            df,
            {
                out: (F.col(c).cast("double") - F.lit(center)) / F.lit(scale)
                for (c, out), center, scale in learned
            },
        )


def lambda_likelihoods(df: DataFrame, points: dict[str, Sequence[float]]) -> dict[str, list[float]]:
    """Yeo-Johnson log-likelihoods of every column at its candidate lambdas, in one pass.

    Columns are laid below each other, so the aggregate has one expression per candidate however
    many columns there are, and the logarithm is taken once per value.
    """
    cols, width = list(points), max(len(lams) for lams in points.values())
    cells = ", ".join(
        f"named_struct('i', {i}, 'x', signum(double({quoted(c)})), "
        f"'l', log1p(abs(double({quoted(c)}))))"
        for i, c in enumerate(cols)
    )
    long = df.selectExpr(f"inline(array({cells}))").filter("x IS NOT NULL AND NOT isnan(x)")
    aggs = [F.expr("count(x) AS n"), F.expr("sum(x * l) AS s")]
    aggs.append(F.expr("min(x * l) = max(x * l) AS same"))
    for j in range(width):
        upper, lower = [], []
        for lams in points.values():
            lam = lams[min(j, len(lams) - 1)]
            # next to the two logarithmic cases the power form is exact to nine digits
            upper.append(lam if abs(lam) > 1e-9 else 1e-9)
            lower.append(2.0 - lam if abs(2.0 - lam) > 1e-9 else 1e-9)
        pick = lambda values: "get(array(" + ", ".join(f"{v!r}D" for v in values) + "), i)"
        power = f"if(x >= 0, {pick(upper)}, {pick(lower)})"
        aggs.append(F.expr(f"var_pop(if(x >= 0, 1D, -1D) * expm1(l * {power}) / {power}) AS v{j}"))
    found = {r["i"]: r for r in long.groupBy("i").agg(*aggs).collect()}
    out = {}
    for i, (c, lams) in enumerate(points.items()):
        r, values = found.get(i), []
        for j, lam in enumerate(lams):
            v = r[f"v{j}"] if r else None
            usable = v is not None and math.isfinite(v) and v > 1e-300 and not r["same"]
            values.append(
                -r["n"] / 2.0 * math.log(v) + (lam - 1.0) * r["s"] if usable else -math.inf
            )
        out[c] = values
    return out


class YeoJohnson(Estimator, _Stage):
    """Power transform whose lambda maximises the likelihood, without standardising.

    Each pass evaluates a small grid of lambdas for all columns at once and narrows it to the
    neighbours of the best one; the last grid is interpolated by a parabola. A constant column
    keeps lambda 1.
    """

    lo = Param(Params._dummy(), "lo", "lowest lambda of the first grid", TypeConverters.toFloat)
    hi = Param(Params._dummy(), "hi", "highest lambda of the first grid", TypeConverters.toFloat)
    passes = Param(Params._dummy(), "passes", "refinement passes", TypeConverters.toInt)

    def __init__(
        self,
        inputs: Sequence[str] | None = None,
        outputs: Sequence[str] | None = None,
        lo: float = -4.0,
        hi: float = 4.0,
        passes: int = 3,
    ):
        super().__init__()
        self._setDefault(lo=-4.0, hi=4.0, passes=3)
        self._columns(inputs, outputs)
        self._set(lo=lo, hi=hi, passes=passes)

    def _fit(self, df: DataFrame) -> YeoJohnsonModel:
        ins = self.getOrDefault(self.inputs)
        base = df.select(*dict.fromkeys(ins))
        spans = {c: (self.getOrDefault(self.lo), self.getOrDefault(self.hi)) for c in ins}
        left = dict.fromkeys(ins, self.getOrDefault(self.passes))
        lams: dict[str, float] = {}
        while spans:
            grids = {
                c: [a + (b - a) * i / (LAMBDA_POINTS - 1) for i in range(LAMBDA_POINTS)]
                for c, (a, b) in spans.items()
            }
            scores = lambda_likelihoods(base, grids)
            for c, grid in grids.items():
                score = scores[c]
                best = max(range(LAMBDA_POINTS), key=lambda i: score[i])
                step = grid[1] - grid[0]
                if score[best] == -math.inf:
                    lams[c] = 1.0
                    del spans[c]
                elif best in (0, LAMBDA_POINTS - 1) and abs(grid[best]) < LAMBDA_LIMIT:
                    reach = 2 * (LAMBDA_POINTS - 1) * step  # the peak lies outside: move on, twice as far
                    ends = (-step, reach) if best else (-reach, step)
                    spans[c] = (grid[best] + ends[0], grid[best] + ends[1])
                    left[c] += 1
                elif left[c] <= 1:
                    if best in (0, LAMBDA_POINTS - 1):
                        warnings.warn(f"lambda of {c!r} ends at {grid[best]:g}, where the likelihood still rises", stacklevel=2)
                    lams[c] = _peak(grid, score, best)
                    del spans[c]
                else:
                    left[c] -= 1
                    spans[c] = (grid[best] - step, grid[best] + step)
        model = YeoJohnsonModel(*map(list, zip(*self.pairs())))
        return model._set(lambdas=[lams[c] for c in ins])


def _peak(grid: Sequence[float], score: Sequence[float], best: int) -> float:
    if best in (0, len(grid) - 1):
        return grid[best]
    a, b, c = score[best - 1 : best + 2]
    bend = a - 2 * b + c
    shift = 0.5 * (a - c) / bend if math.isfinite(bend) and bend < 0 else 0.0
    return grid[best] + shift * (grid[1] - grid[0])


class YeoJohnsonModel(Model, _Stage):
    lambdas = Param(Params._dummy(), "lambdas", "learned lambdas", TypeConverters.toListFloat)

    def __init__(self, inputs: Sequence[str] | None = None, outputs: Sequence[str] | None = None):
        super().__init__()
        self._columns(inputs, outputs)

    def _transform(self, df: DataFrame) -> DataFrame:
        learned = zip(self.pairs(), self.getOrDefault(self.lambdas), strict=True)
        return _write(df, {out: yeo_johnson(c, lam) for (c, out), lam in learned})


def one_hot(cols: Sequence[str], prefix: str = "") -> list[Estimator]:
    """All training categories get a slot; an unseen or missing one is all zeros."""
    if not cols:
        return []
    codes = [f"{prefix}{c}__code" for c in cols]
    hots = [f"{prefix}{c}__hot" for c in cols]
    return [
        StringIndexer(
            inputCols=[f"{prefix}{c}" for c in cols], outputCols=codes,
            handleInvalid="keep", stringOrderType="alphabetAsc",
        ),
        OneHotEncoder(inputCols=codes, outputCols=hots, dropLast=True, handleInvalid="error"),
    ]


def route(
    skewed: Sequence[str],
    regular: Sequence[str],
    categorical: Sequence[str],
    features: str = "features",
) -> list:
    """Stages per column role, assembled in the order skewed, regular, categorical.

    Work happens on prefixed copies, so the raw columns stay as they came.
    """
    mark = "__f_"
    numeric = [*skewed, *regular]
    made = [f"{mark}{c}" for c in numeric]
    made_skewed, made_categorical = made[: len(skewed)], [f"{mark}{c}" for c in categorical]
    stages: list = []
    if numeric:
        stages.append(MedianImputer(numeric, made))
    if skewed:
        stages.append(YeoJohnson(made_skewed))
    if numeric:
        stages.append(RobustScale(made))
    if categorical:
        stages.append(ModeImputer(categorical, made_categorical))
        stages += one_hot(categorical, mark)
    hots = [f"{c}__hot" for c in made_categorical]
    stages.append(VectorAssembler(inputCols=[*made, *hots], outputCol=features))
    codes = [f"{c}__code" for c in made_categorical]
    stages.append(DropColumns([*made, *made_categorical, *codes, *hots]))
    return stages


def feature_stages(spec: TableSpec, power: bool = True, ratios: bool = True) -> list:
    """Fresh stages for a table; the two switches build the variants of an ablation."""
    derived = {r[0] for r in spec.ratios}
    skewed = [c for c in spec.skewed if ratios or c not in derived]
    first = [RatioFeatures(spec.ratios)] if spec.ratios and ratios else []
    if not power:
        return first + route([], [*skewed, *spec.regular], spec.categorical)
    return first + route(skewed, spec.regular, spec.categorical)


def build_feature_pipeline(spec: TableSpec) -> Pipeline:
    from tallymark.operators.together import FeaturePipeline

    return FeaturePipeline(stages=feature_stages(spec))


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector slots: numeric columns, then column_category."""
    mark, labels, names = "__f_", {}, []
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel):
            labels.update(zip(stage.getInputCols(), stage.labelsArray))
        if isinstance(stage, VectorAssembler):
            for c in stage.getInputCols():
                plain = c.removeprefix(mark)
                if c.endswith("__hot"):
                    source = c.removesuffix("__hot")
                    names += [f"{plain.removesuffix('__hot')}_{v}" for v in labels[source]]
                else:
                    names.append(plain)
    return names


def fit_transform(
    pipe: Pipeline, train: DataFrame, test: DataFrame
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Learn from train, apply to both, and name the slots."""
    model = pipe.fit(train)
    return model.transform(train), model.transform(test), feature_names(model)


def fitted_parameters(model: PipelineModel) -> DataFrame:
    """What each stage learned: ``stage, feature, parameter, value`` (numbers as text)."""
    rows = []

    def tell(stage, kind, param, values):
        for (c, _), v in zip(stage.pairs(), values, strict=True):
            rows.append(
                {"stage": kind, "feature": c.removeprefix("__f_"), "parameter": param, "value": str(v)}
            )

    for stage in model.stages:
        if isinstance(stage, MedianImputerModel):
            tell(stage, "median_imputer", "median", stage.getOrDefault(stage.medians))
        elif isinstance(stage, YeoJohnsonModel):
            tell(stage, "yeo_johnson", "lambda", stage.getOrDefault(stage.lambdas))
        elif isinstance(stage, RobustScaleModel):
            tell(stage, "robust_scale", "center", stage.getOrDefault(stage.centers))
            tell(stage, "robust_scale", "scale", stage.getOrDefault(stage.scales))
        elif isinstance(stage, ModeImputerModel):
            tell(stage, "mode_imputer", "mode", stage.getOrDefault(stage.modes))
    from pyspark.sql import SparkSession

    schema = T.StructType.fromDDL("stage string, feature string, parameter string, value string")
    return local_frame(SparkSession.active(), rows, schema)


def log1p_column(c: str):
    """Extras named beside the main transforms: plain column functions."""
    return F.log1p(F.col(c).cast("double"))


def sqrt_column(c: str):
    return F.sqrt(F.col(c).cast("double"))


def square_column(c: str):
    x = F.col(c).cast("double")
    return x * x


def interaction(cols: Sequence[str], out: str) -> Interaction:
    """Products of all entries of the given numeric or vector columns."""
    return Interaction(inputCols=list(cols), outputCol=out)
