import math

import numpy as np
import pytest

from tallymark.llm import whitening as w
from tallymark.llm.spectrum import count_above, leading

SCHEMA = "vec_id bigint, embedding array<float>, whitened string, n int, v string"


def matrices():
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(24, 24)))
    spread = np.concatenate([[9.0, 9.0, 9.0, 5.0, 5.0 + 1e-9], np.linspace(4, 0.5, 15), np.zeros(4)])
    yield (q * spread) @ q.T
    a = rng.normal(size=(40, 12))
    yield a.T @ a / 40
    yield np.diag([3.0, 1.0, 2.0, 2.0, 0.0])
    yield np.array([[0.0, 1.0], [1.0, 0.0]])
    yield np.array([[4.0]])
    yield 1e12 * (a.T @ a) + np.eye(12)


@pytest.mark.parametrize("v", list(matrices()), ids=str)
def test_leading_pairs(v):
    v = (v + v.T) / 2
    e = np.linalg.eigvalsh(v)[::-1]
    norm = np.abs(e).max()
    for shift in [*(e[:-1] + e[1:]) / 2, -2 * norm, 2 * norm]:
        if np.abs(e - shift).min() > 1e-8 * norm:
            assert count_above(v, shift) == (e > shift).sum()
    values, vectors = leading(v, 32)
    assert np.allclose(values, e[:32], atol=1e-12 * norm)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(v @ vectors.T, vectors.T * values, atol=1e-11 * norm)


def brute(rows, components=32):
    kept = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v, *_ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([r for _, r in kept], dtype=object)
    n, s = len(x), x.sum(axis=0)
    away = (n * x - s).astype(float) / n
    e, q = np.linalg.eigh(away.T @ away / n)
    e, q = e[::-1], q[:, ::-1]
    deviations = ((n * x - s) ** 2).sum(axis=1)
    return [i for i, _ in kept], deviations, away @ q / np.sqrt(np.abs(e)), e / e.sum()


def collect(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["vec_id"], []).append(r)
    return out


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 40)) * np.linspace(0.2, 2.0, 40)
    rows = [(i, [float(c) for c in v], "x", 1, "y") for i, v in enumerate(base)]
    rows += [(900, None, "", 0, ""), (901, [], "", 0, ""), (902, [None] * 40, "", 0, ""), (903, [float("nan")] * 40, "", 0, ""), (904, [float("inf")] + [0.0] * 39, "", 0, "")]
    got = w.embeddings_whitened(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    ids, deviations, z, share = brute(rows)
    found = collect(got)
    assert sorted(found) == sorted(ids)
    signs = np.sign([r["whitened"] for r in sorted(found[0], key=lambda r: r["component"])]) * np.sign(z[0][:32])
    for k, i in enumerate(ids):
        mine = sorted(found[i], key=lambda r: r["component"])
        assert [r["component"] for r in mine] == list(range(1, 33))
        assert {r["deviation"] for r in mine} == {deviations[k]} and {r["n"] for r in mine} == {len(ids)}
        assert np.allclose([r["whitened"] for r in mine], signs * z[k][:32], atol=1e-8)
        assert np.allclose([r["explained"] for r in mine], share[:32], rtol=1e-9)
    assert {r["identity_error"] for r in got.collect()} == {found[0][0]["identity_error"]} and found[0][0]["identity_error"] < 1e-10


def test_copies_lengths_and_extra_columns(spark):
    rows = [(1, [1.0, 2.0, 0.0], "a", 1, "b"), (1, [1.0, 2.0, 0.0], "a", 1, "b"), (None, [2.0, -1.0, 0.0], None, 2, None), (4, [0.5, 9.0], "", 0, "")]
    df = spark.createDataFrame(rows, SCHEMA)
    model = w.fit(df)
    assert (model.dims, model.n, len(model.values)) == (3, 3, 1)
    out = w.transform(df, model)
    assert out.columns == ["vec_id", "embedding", "n", "v", "whitened", "deviation"] and out.count() == 3
    assert {r["v"] for r in out.collect()} == {"b", None}
    assert w.embeddings_whitened(df).count() == 3


def test_no_rows_no_variance_and_huge_values(spark):
    assert w.embeddings_whitened(spark.createDataFrame([], SCHEMA)).collect() == []
    same = spark.createDataFrame([(i, [0.5, 0.5], "", 0, "") for i in range(4)], SCHEMA)
    assert w.embeddings_whitened(same).collect() == [] and w.fit(same).n == 4
    huge = spark.createDataFrame([(0, [1e30, 0.0], "", 0, ""), (1, [-1e30, 1.0], "", 0, ""), (2, [0.0, 1.0], "", 0, "")], SCHEMA)
    found = w.embeddings_whitened(huge).collect()
    assert len(found) >= 3 and {r["deviation"] for r in found if r["vec_id"] != 2} == {None}
    assert all(math.isfinite(r["whitened"]) for r in found)
