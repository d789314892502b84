"""Many columns through matrix products, and densities from binned rows."""

import math

import numpy as np
import pandas as pd
import pytest

from tallymark.operators import association as assoc
from tallymark.operators import describe as desc


def matrix(df, cols):
    return {(r["a"], r["b"]): r["r"] for r in df.collect()}, [(a, b) for a in cols for b in cols]


def same(got, want):
    if got is None or want is None:
        return got is None and want is None
    return math.isnan(got) and math.isnan(want) or math.isclose(got, want, abs_tol=1e-9)


@pytest.fixture(scope="module")
def hard(spark):
    """Missing values, offsets, constants, a column without values, one with NaN and one with a dot in its name."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12))
    x[:, 1] += 1e5
    x[:, 2] = 0.1
    table = {f"c{i}": [None if rng.random() < 0.1 else float(v) for v in x[:, i]] for i in range(12)}
    table["c3"] = [None] * 400
    table["c.4"] = table.pop("c4")
    table["c5"] = [float("nan") if i == 7 else v for i, v in enumerate(table["c5"])]
    table["c6"] = [v if i < 200 else None for i, v in enumerate(table["c6"])]
    table["c7"] = [5.0 if i < 200 else v for i, v in enumerate(table["c7"])]  # constant wherever c6 is there
    names = list(table)
    return spark.createDataFrame(list(zip(*table.values())), ", ".join(f"`{c}` double" for c in names)).repartition(5), names


def test_blocks_equal_the_plain_matrix(hard):
    df, names = hard
    plain, keys = matrix(assoc.corr_matrix(df, names), names)
    got, _ = matrix(assoc.corr_blocks(df, names), names)
    assert set(got) == set(keys) == set(plain)
    assert [k for k in keys if not same(got[k], plain[k])] == []
    assert got[("c6", "c7")] is None and got[("c2", "c2")] is None and got[("c3", "c1")] is None
    assert [r["r"] for r in assoc.corr_blocks(df.limit(0), names[:2]).collect()] == [None] * 4


def test_three_hundred_columns(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(500, 300)) + rng.normal(size=(500, 1))
    names = [f"v{i}" for i in range(300)]
    got = assoc.corr_matrix(spark.createDataFrame(pd.DataFrame(x, columns=names)), names).toPandas()
    table = got.pivot(index="a", columns="b", values="r").loc[names, names].to_numpy()
    assert len(got) == 300 * 300 and np.allclose(table, np.corrcoef(x.T), atol=1e-12)


@pytest.mark.parametrize("grid", [1, 7, 200])
def test_density_is_the_direct_sum(spark, grid):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=3000), rng.exponential(5, size=500), [400.0, -90.0], np.repeat(1.25, 300)])
    df = spark.createDataFrame(pd.DataFrame({"x": x})).unionByName(spark.createDataFrame([(None,)], "x double"))
    got = desc.kde(df, "x", grid).orderBy("x").collect()
    h = x.std(ddof=1) * x.size ** -0.2
    assert len(got) == grid
    for r in got:
        want = np.exp(-0.5 * ((x - r["x"]) / h) ** 2).sum() / (x.size * h * math.sqrt(2 * math.pi))
        assert math.isclose(r["density"], want, rel_tol=1e-9, abs_tol=1e-12)


def test_no_spread_has_no_density(spark):
    for rows in ([(2.0,), (2.0,)], [(1.0,)], [(None,)], []):
        with pytest.raises(ValueError):
            desc.kde(spark.createDataFrame(rows, "x double"), "x")


def test_a_large_offset_costs_no_digits(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=400)
    y = x + rng.normal(size=400) + 2.0**30
    want = np.corrcoef(x, y - 2.0**30)[0, 1]  # the difference is exact
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y})).repartition(5)
    got = {(r["a"], r["b"]): r["r"] for r in assoc.corr_blocks(df, ["x", "y"]).collect()}
    assert abs(got[("x", "y")] - want) < 1e-13 and got[("x", "x")] == 1.0
