import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.llm import quality, shrinkage
from tallymark.llm.common import table

SF = "/root/testdata/sf0.1"


def plain_posteriors(groups, depth):
    """{keys: (alpha, beta)} of the finest level, level by level in plain Python; groups: {keys: (n, bad)}."""
    n, bad = (sum(g[i] for g in groups.values()) for i in (0, 1))
    found = {(): (bad + 0.5, n - bad + 0.5)}
    for d in range(1, depth + 1):
        level = {}
        for keys, (a, b) in groups.items():
            x = level.setdefault(keys[:d], [0, 0])
            x[0] += a
            x[1] += b
        mean = {k: (found[k[:-1]][0] - v[1]) / (sum(found[k[:-1]]) - v[0]) for k, v in level.items()}
        some = [(k, v) for k, v in level.items() if v[0]]
        spread = sum(v[0] * (v[1] / v[0] - mean[k]) ** 2 for k, v in some)
        expected = sum(mean[k] * (1 - mean[k]) for k, _ in some)
        weight = sum(mean[k] * (1 - mean[k]) * (v[0] - 1) for k, v in some)
        s = shrinkage.strength(spread, expected, weight) if some else shrinkage.UNKNOWN
        found = {k: (mean[k] * s + v[1], (1 - mean[k]) * s + v[0] - v[1]) for k, v in level.items()}
    return found


@pytest.mark.parametrize("rows", [
    {("h1", "a"): (40, 30), ("h1", "b"): (3, 0), ("h2", "a"): (100, 4), ("h3", "c"): (0, 0), ("h2", "d"): (1, 1)},
    {("h", "a"): (0, 0)}, {("h", "a"): (5, 5)}, {},
])
def test_posteriors_equal_plain_python(spark, rows):
    df = spark.createDataFrame([(*k, *v) for k, v in rows.items()], "host string, path string, n bigint, bad bigint")
    got = {(r.host, r.path): (r.alpha, r.beta) for r in shrinkage.posteriors(df, ["host", "path"]).collect()}
    wanted = plain_posteriors(rows, 2)
    assert got.keys() == wanted.keys()
    assert all(np.allclose(got[k], wanted[k]) for k in wanted)


def test_evidence_is_the_sum_of_present_features():
    texts = ["IDIOT!! you", "a plain text", "", None, "x " * 5000, "### a ### b"]
    rows, found = quality.features(pa.array(texts))
    chosen = np.unique(found)[::2]
    model = quality.Model(chosen, np.linspace(-1, 1, len(chosen)), 0.25)
    every = model.evidence(pa.array(texts))
    for i in range(len(texts)):
        present = set(found[rows == i].tolist())
        assert math.isclose(every[i], 0.25 + sum(w for c, w in zip(chosen.tolist(), model.weights) if c in present), abs_tol=1e-9)
        assert math.isclose(model.evidence(pa.array([texts[i]], pa.string()))[0], every[i], abs_tol=1e-9)


def test_bad_documents_are_rejected_and_clean_ones_kept(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    judged = quality.documents_quality(docs, labels).join(labels, "doc_id", "left")
    assert judged.count() == docs.count()
    counts = {(r.quality, r.toxic, r.keep): r["count"] for r in judged.groupBy("quality", "toxic", "keep").count().collect()}
    share = lambda q, t, k: counts.get((q, t, k), 0) / (counts.get((q, t, True), 0) + counts.get((q, t, False), 0))
    assert share(1, 0, True) > 0.99 and share(0, 0, False) > 0.95 and share(1, 1, False) > 0.85 and share(0, 1, False) > 0.95


def test_held_out_labels(spark):
    """Fitted on four fifths of the labels, the model ranks the others: area under the curve over 0.97, few clean ones rejected."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rest = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    judged = quality.classify(docs, labels.filter(~rest)).join(quality.document_outcomes(labels.filter(rest)), "doc_id")
    rows = [(r.bad_probability, r.is_bad, r.keep) for r in judged.select("bad_probability", "is_bad", "keep").collect()]
    bad, good = ([p for p, b, _ in rows if b is kind] for kind in (True, False))
    wins = sum((np.array(good) < p).sum() + 0.5 * (np.array(good) == p).sum() for p in bad)
    assert len(bad) > 100 and wins / (len(bad) * len(good)) > 0.97
    assert sum(k for _, b, k in rows if not b) > 0.97 * len(good)


def test_newton_steps_do_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    x = (rng.random((300, 6)) < 0.4).astype(np.int8)
    y = (rng.random(300) < 1 / (1 + np.exp(1 - x @ np.arange(6.0)))).astype(np.float32)
    whole = quality._logistic(x, y)
    monkeypatch.setattr(quality, "CHUNK", 7)
    parts = quality._logistic(x, y)
    assert np.allclose(whole[0], parts[0], atol=1e-6) and np.isclose(whole[1], parts[1], atol=1e-6)


def test_the_site_counts(spark):
    """Without evidence in the text the decision is the site's: a rate over one half rejects."""
    docs = [(i, f"t{i}", "bad.org/x/1" if i < 60 else "good.org/y", "k", 0.5) for i in range(120)] + [(200, None, None, None, None), (201, "", "bad.org/x/2", "", 0.0), (None, "t", "new.org", "", 0.0)]
    labels = [(i, 0 if i < 60 else 1, 0) for i in range(0, 120, 2)] + [(None, 0, 0), (3, None, None), (0, 0, 1)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, source string, keep string, host double")
    out = quality.classify(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(docs) and set(df.columns) - {"keep"} <= set(out[0].__fields__)
    assert by[201].site_outcomes == 30 and by[201].site_rate > 0.8 and not by[1].keep and by[61].keep
    assert by[200].site_outcomes == 0 and abs(by[200].site_rate - 0.5) < 0.1 and by[None].site_outcomes == 0


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a", "s")], "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    (row,) = quality.classify(docs, labels, threshold=0.6).collect()
    assert row.evidence == 0 and row.keep and row.site_rate == 0.5
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_sites(spark):
    df = spark.createDataFrame([("https://a.b/c/d",), ("a.b/c?x/y",), ("src1",), (None,), ("a/b/c",)], "source string")
    got = [tuple(r) for r in df.select(*quality.site(F.col("source"))).collect()]
    assert got == [("a.b", "a.b/c"), ("a.b", "a.b/c"), ("src1", "src1"), ("", ""), ("a", "a/b")]
