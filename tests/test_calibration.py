"""The monotone map against the max-min formula and the logistic curve against a plain optimum."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import calibration as cal


def max_min(points):
    """Value of each (x, weight, sum) in the order of x: the largest over left ends of the smallest mean over right ends."""
    w = np.cumsum([0.0] + [p[1] for p in points])
    s = np.cumsum([0.0] + [p[2] for p in points])
    n = len(points)
    best = np.full(n, -np.inf)
    for a in range(n):
        means = (s[a + 1:] - s[a]) / (w[a + 1:] - w[a])
        best[a:] = np.maximum(best[a:], np.minimum.accumulate(means[::-1])[::-1])
    return best


def rows_of(seed, n, spread):
    rng = random.Random(seed)
    return [(i, float(rng.randint(-spread, spread)) * 1.5, int(rng.random() < 0.3 + 0.4 * (i % 5 == 0))) for i in range(n)]


def expected(rows, asked):
    cells = {}
    for _, x, y in rows:
        w, s = cells.get(x, (0, 0))
        cells[x] = (w + 1, s + y)
    points = [(x, *cells[x]) for x in sorted(cells)]
    return np.interp(asked, [p[0] for p in points], max_min(points))


@pytest.mark.parametrize("limits", [(200_000, 50_000), (17, 50_000), (17, 0)])
def test_equals_max_min(spark, monkeypatch, limits):
    monkeypatch.setattr(cal, "RANGE_ROWS", limits[0])
    monkeypatch.setattr(cal, "LOCAL_BLOCKS", limits[1])
    rows = [(i, x, int(y or x > 30)) for i, x, y in rows_of(3, 300, 60)]
    curve = cal.isotonic(spark.createDataFrame(rows, "id int, score double, label int"))
    asked = [float(v) for v in range(-120, 121, 7)] + [rows[0][1], 0.25] * 2
    got = curve.transform(spark.createDataFrame([(i, v) for i, v in enumerate(asked)], "id int, score double")).orderBy("id").collect()
    assert np.allclose([r["calibrated"] for r in got], expected(rows, asked), atol=1e-12)


def test_falling_labels_become_one_block(spark, monkeypatch):
    monkeypatch.setattr(cal, "RANGE_ROWS", 5)
    curve = cal.isotonic(spark.createDataFrame([(float(i), 100 - i) for i in range(100)], "score double, label int"))
    assert curve.size == 1 and curve.blocks.first()["value"] == 50.5


@pytest.mark.parametrize("local", [50_000, 0])
def test_missing_values_and_no_rows(spark, monkeypatch, local):
    monkeypatch.setattr(cal, "LOCAL_BLOCKS", local)
    nan, inf = float("nan"), float("inf")
    rows = [(1.0, 0, 1.0), (2.0, 1, 3.0), (2.0, 0, 1.0), (None, 1, 1.0), (nan, 1, 1.0), (inf, 1, 1.0), (0.0, None, 1.0), (0.0, 1, 0.0)]
    schema = "score double, label int, calibrated double"
    curve = cal.isotonic(spark.createDataFrame(rows, schema), weight="calibrated")
    asked = spark.createDataFrame([(i, x, 9.0) for i, x in enumerate([None, nan, -inf, inf, 0.0, 1.5, 2.0])], "id int, score double, calibrated double")
    found = curve.transform(asked)
    assert sorted(found.columns) == ["calibrated", "id", "score"]
    assert [r["calibrated"] for r in found.orderBy("id").collect()] == [None, None, 0.0, 0.75, 0.0, 0.375, 0.75]
    none = cal.isotonic(spark.createDataFrame([], schema)).transform(asked)
    assert {r["calibrated"] for r in none.collect()} == {None}


def test_a_million_margins(spark):
    """Every score is different and far outside [0, 1]; five ranges, equal to one task's pooling."""
    df = spark.range(1_000_000).select(
        (F.col("id") * 1.7 - 9e5).alias("score"), (F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < F.col("id")).cast("int").alias("label")
    )
    curve = cal.isotonic(df)
    one = cal.pool_adjacent(df.toPandas().assign(lo=lambda d: d.score, hi=lambda d: d.score, w=1.0, s=lambda d: d.label.astype(float)))
    got = curve.blocks.orderBy("lo").toPandas()
    assert len(got) == len(one) == curve.size and (got["lo"] == one["lo"]).all() and np.allclose(got["value"], one["s"] / one["w"], rtol=0, atol=1e-12)


def test_logistic_curve(spark):
    rng = random.Random(8)
    rows = [(rng.gauss(3000, 500),) for _ in range(800)]
    rows = [(x, int(rng.random() < 1 / (1 + math.exp(-(x - 3200) / 200)))) for x, in rows] + [(None, 1), (float("nan"), 0), (1.0, None)]
    curve = cal.platt(spark.createDataFrame(rows, "score double, label int"))
    kept = [(x, y) for x, y in rows[:800]]
    x, y = np.array([r[0] for r in kept]), np.array([r[1] for r in kept])
    aim = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    p = 1 / (1 + np.exp(-(curve.slope * x + curve.intercept)))
    assert abs((p - aim).sum()) < 1e-6 and abs(((p - aim) * (x - x.mean()) / x.std()).sum()) < 1e-6
    split = cal.platt(spark.createDataFrame([(float(i), int(i >= 50)) for i in range(100)], "score double, label int"))
    assert 0 < split.slope < math.inf
    flat = cal.platt(spark.createDataFrame([(2.0, 1), (2.0, 0), (2.0, 0)], "score double, label int"))
    assert flat.slope == 0 and flat.intercept < 0
    assert cal.platt(spark.createDataFrame([], "score double, label int")).slope == 0
