"""Exact order statistics, cuts and running totals against brute force, with every size limit
lowered so that the paths for large tables run on small ones."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators import ordering as o

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


def numbers(spark, values, groups=None):
    rows = [
        (i, None if v is None else float(v), None if groups is None else groups[i])
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "id long, x double, g string").repartition(4)


SHAPES = {
    "even": [1, 2, 3, 10],
    "one": [7],
    "hot": [5.0] * 400 + list(np.linspace(0, 10, 800)),
    "spread": list(np.random.default_rng(1).lognormal(0, 2, 3000)),
    "nulls": [None, 3, None, 1, 2],
    "negative": [-0.0, 0.0, -5, 5, -5, 2.5],
}


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("limits", ["plain", "brackets", "narrowed", "sampled"])
def test_quantiles_equal_numpy(spark, monkeypatch, shape, limits):
    if limits != "plain":
        monkeypatch.setattr(o, "WHOLE_ROWS", 2 if limits == "brackets" else 100)
    if limits == "narrowed":
        monkeypatch.setattr(o, "SKETCH_ACCURACY", 100)
        monkeypatch.setattr(o, "BRACKET_ROWS", 60)
        monkeypatch.setattr(o, "GRID", 20)
    if limits == "sampled":
        monkeypatch.setattr(o, "SAMPLE_ABOVE", 100)
        monkeypatch.setattr(o, "SAMPLE_ROWS", 300)
        monkeypatch.setattr(o, "BRACKET_ROWS", 500)
        monkeypatch.setattr(o, "GRID", 20)
        monkeypatch.setattr(o, "WHOLE_ROWS", 50)
    if limits == "brackets":
        monkeypatch.setattr(o, "SKETCH_ACCURACY", 50)
        monkeypatch.setattr(o, "WHOLE_ROWS", 200)
    values = SHAPES[shape]
    got = o.quantile_values(numbers(spark, values), ["x"], PROBS)["x"]
    want = np.percentile([v for v in values if v is not None], [100 * p for p in PROBS])
    assert np.allclose(got, want, rtol=0, atol=1e-12)


@pytest.mark.parametrize("small_rows", [20_000, 0])
def test_grouped_quantiles_with_null_group_and_large_fit(spark, monkeypatch, small_rows):
    rng = np.random.default_rng(3)
    values = list(rng.normal(size=900))
    groups = [("a" if i < 600 else "b") if i % 7 else None for i in range(900)]  # "a" is hot
    monkeypatch.setattr(o, "WHOLE_ROWS", 50)
    monkeypatch.setattr(o, "SKETCH_ACCURACY", 200)
    monkeypatch.setattr(o.settle, "__defaults__", (small_rows,))
    rows = o.order_stats(
        numbers(spark, values, groups), ["x"], [0.25, 0.5], ["g"], {"mean": "avg({x})"}
    ).collect()
    assert {r["g"] for r in rows} == {"a", "b", None}
    for r in rows:
        mine = [v for v, g in zip(values, groups) if g == r["g"]]
        assert r["count"] == len(mine)
        assert np.allclose(r["quantiles"], np.percentile(mine, [25, 50]), atol=1e-12)
        assert np.isclose(r["mean"], np.mean(mine))


def test_a_missed_bracket_is_tried_again_wider(spark, monkeypatch):
    monkeypatch.setattr(o, "WHOLE_ROWS", 5)
    monkeypatch.setattr(o, "SKETCH_ACCURACY", 10_000_000)  # far too narrow for the neighbour rank
    values = list(np.random.default_rng(9).normal(size=1000))
    got = o.quantile_values(numbers(spark, values), ["x"], [0.25, 0.5])["x"]
    assert np.allclose(got, np.percentile(values, [25, 50]), atol=1e-12)


def brute_order(ids, seed=42):
    return sorted(ids, key=lambda i: hashlib.md5(f"{i}|{seed}".encode()).hexdigest())


@pytest.mark.parametrize("leaf", [200_000, 10, 1])
def test_cuts_reach_exact_ranks_in_a_hot_class(spark, monkeypatch, leaf):
    monkeypatch.setattr(o, "LEAF_ROWS", leaf)
    monkeypatch.setattr(o, "PREFIX_DIGITS", 1)
    df = spark.range(3000).withColumn("y", F.when(F.col("id") % 10 == 0, 1).otherwise(0))
    sizes = o.class_counts(df, "y")
    ranks = {0: [0, 500, 2700], 1: [1, 150, 299]}
    marked = o.fit_cuts(df, "y", "id", 42, ranks, sizes).mark(df, "step").collect()
    for y in (0, 1):
        order = brute_order([r["id"] for r in marked if r["y"] == y])
        place = {i: n for n, i in enumerate(order, 1)}
        for r in marked:
            if r["y"] == y:
                assert r["step"] == sum(place[r["id"]] > k for k in ranks[y])


def test_rows_that_share_a_key_stay_together(spark, monkeypatch):
    monkeypatch.setattr(o, "LEAF_ROWS", 10)
    df = spark.range(900).select(F.when(F.col("id") < 300, 7).otherwise(F.col("id")).alias("k"))
    cuts = o.fit_cuts(df, None, "k", 42, {None: [450]}, {None: 900})
    marked = cuts.mark(df, "step")
    assert marked.filter("k = 7").select("step").distinct().count() == 1
    assert marked.count() == 900


def test_sample_is_the_lowest_hashes(spark):
    got = sorted(r[0] for r in o.sample_rows(spark.range(500), 37, "id").collect())
    assert got == sorted(brute_order(range(500))[:37])
    assert o.sample_rows(spark.range(5), 10, "id").count() == 5


@pytest.mark.parametrize("limit", [1_000_000, 40])
@pytest.mark.parametrize("ascending", [True, False])
def test_running_totals_equal_cumsum(spark, monkeypatch, limit, ascending):
    monkeypatch.setattr(o, "BUCKET_ROWS", limit)
    rng = np.random.default_rng(5)
    cells = {("a", float(v)): int(n) for v, n in zip(rng.permutation(400), rng.integers(1, 9, 400))}
    cells |= {("b", float(v)): 2 for v in range(30)}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in cells.items()], "g string, v double, n long")
    got = {
        (r["g"], r["v"]): r["cum_n"]
        for r in o.running_totals(df, "v", ["n"], ["g"], ascending).collect()
    }
    for g in "ab":
        total = 0
        for v in sorted((v for h, v in cells if h == g), reverse=not ascending):
            total += cells[(g, v)]
            assert got[(g, v)] == total


def test_most_frequent_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame(
        [("b", "x"), ("a", "x"), ("b", None), ("a", "y"), (None, "y")], "p string, q string"
    )
    got = {r["column"]: (r["value"], r["count"]) for r in o.most_frequent(df, ["p", "q"]).collect()}
    assert got == {"p": ("a", 2), "q": ("x", 2)}


def test_split_evenly():
    assert o.split_evenly(7, 3) == [3, 5, 7]
    assert o.split_evenly(2, 4) == [1, 2, 2, 2]
