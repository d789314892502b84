"""Ingest, quality, profile and association operators on hand-made frames."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.functions.columns import cut, map_values, safe_ratio
from tallymark.operators import association as assoc
from tallymark.operators import describe as desc
from tallymark.operators import prepare as prep
from tallymark.operators import quality
from tallymark.sources import ingest as ing
from tallymark.spec import CLINICAL

HEADER = ",".join(CLINICAL.columns) + ",,,\n"


def write(path, *lines):
    path.write_text(HEADER + "".join(line + "\n" for line in lines))
    return str(path)


def test_csv_to_typed_table(spark, tmp_path):
    path = write(
        tmp_path / "raw.csv",
        "65.0,Female,0.7,0.1,187, 16 ,18,6.8,3.3,0.9,1,,,",
        "?,-,NA,N/A,NULL,null, ,,nan,x,2,,,",
        "40.5,Male,1,1,1,1,1,1,1,1,,,,",
    )
    raw = ing.read_csv(spark, path, CLINICAL)
    assert raw.columns == list(CLINICAL.columns)
    rows = ing.ingest(raw, CLINICAL).collect()
    assert rows[0]["Age"] == 65 and rows[0]["Alamine_Aminotransferase"] == 16.0
    assert rows[0]["Diagnosis"] == 1
    assert [v for k, v in rows[1].asDict().items() if k != "Diagnosis"] == [None] * 10
    assert rows[2]["Age"] is None and rows[2]["Diagnosis"] is None  # 40.5 is no whole age


def test_source_errors_are_distinct(spark, tmp_path):
    with pytest.raises(ing.SourceMissing):
        ing.read_csv(spark, str(tmp_path / "none.csv"), CLINICAL)
    (tmp_path / "other.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ing.SourceUnreadable):
        ing.read_csv(spark, str(tmp_path / "other.csv"), CLINICAL)
    with pytest.raises(ing.SourceMissing):
        ing.read_layer(spark, str(tmp_path), "primary", "none")
    with pytest.raises(ing.ArtifactMissing):
        ing.load_artifact(spark, str(tmp_path / "none"))


def test_layers_and_requests(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k long, s string")
    path = ing.write_layer(df, str(tmp_path), "intermediate", "t")
    assert ing.verify_roundtrip(df, path)
    assert not ing.verify_roundtrip(df.limit(1), path)
    assert ing.to_frame(spark, [{"s": "x", "k": 3}], "k long, s string").first() == (3, "x")
    with pytest.raises(ing.SourceUnreadable):
        ing.to_frame(spark, [{"k": 3}], "k long, s string")


def test_nan_and_null_are_one(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (float("nan"),)], "x double")
    got = desc.describe(ing.nan_to_null(df), ["x"]).first()
    assert (got["count"], got["p50"], got["p25"]) == (4, 2.5, 1.75)


def test_duplicates_with_nulls_and_signed_zero(spark):
    df = spark.createDataFrame(
        [(1.0, None), (1.0, None), (0.0, "a"), (-0.0, "a"), (2.0, "b"), (1.0, None)], "x double, s string"
    )
    got = quality.duplicate_summary(df).first()
    assert (got["row_count"], got["duplicates"], got["pct"]) == (6, 3, 50.0)
    assert quality.duplicate_summary(df, digest=True).first()["duplicates"] == 3
    assert quality.duplicate_rows(df, limit=3).collect() == [(0.0, "a"), (0.0, "a"), (1.0, None)]
    assert quality.duplicate_rows(df, limit=None).count() == 5
    assert prep.drop_exact_duplicates(df).count() == 3
    keyed = df.withColumn("id", F.monotonically_increasing_id())
    kept = prep.drop_exact_duplicates(keyed, ["id"])
    assert kept.columns == keyed.columns and kept.count() == 3


def test_hot_duplicate_group_is_written_out_in_steps(spark, monkeypatch):
    monkeypatch.setattr(quality, "COPIES_PER_TASK_STEP", 10)
    df = spark.range(107).select(F.when(F.col("id") < 95, 1).otherwise(F.col("id")).alias("x"))
    out = quality.duplicate_rows(df, limit=None)
    assert out.count() == 95 and out.distinct().count() == 1


def test_null_profile_and_validation(spark):
    df = spark.createDataFrame([(1, None), (None, None), (30, "a")], "age long, s string")
    assert [tuple(r) for r in quality.null_profile(df, decimals=2).collect()] == [
        ("s", 2, 66.67), ("age", 1, 33.33)
    ]
    report, good, bad = quality.validate(df, {"adult": F.col("age") >= 18})
    assert tuple(report.first())[:2] == ("adult", 1)
    assert good.count() == 2 and bad.first()["broken_rules"] == ["adult"]
    summary = {r["metric"]: r["count"] for r in quality.quality_summary(df, "s").collect()}
    assert summary == {"Missing target": 2, "Exact duplicate rows": 0}


def test_cut_is_right_closed_and_includes_the_lowest(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 20.0, 20.0001, 40.0, 100.0, 101.0, -1.0, None)], "x double")
    edges, labels = [0, 20, 40, 60, 80, 100], ["0-20", "21-40", "41-60", "61-80", "81-100"]
    got = [r[0] for r in df.select(cut("x", edges, labels)).collect()]
    assert got == ["0-20", "0-20", "21-40", "21-40", "81-100", None, None, None]


def test_ratio_and_mapping(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1), (3.0, 2.0, 2), (None, 1.0, None)], "a double, b double, c long")
    assert [r[0] for r in df.select(safe_ratio("a", "b")).collect()] == [None, 1.5, None]
    assert [r[0] for r in df.select(map_values("c", {1: 1, 2: 0})).collect()] == [1, 0, None]


def test_histogram_kde_and_box(spark):
    x = np.random.default_rng(0).gamma(2.0, 3.0, 700)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    width = min(
        np.ptp(x) / (np.log2(x.size) + 1),
        2 * (np.percentile(x, 75) - np.percentile(x, 25)) / x.size ** (1 / 3),
    )
    counts, edges = np.histogram(x, int(np.ceil(np.ptp(x) / width)))
    got = desc.histogram(df, "x").orderBy("bin").collect()
    assert [r["n"] for r in got] == [n for n in counts if n]
    assert np.allclose([r["low"] for r in got], edges[:-1][counts > 0])
    assert [r["n"] for r in desc.histogram(df, "x", 40).orderBy("bin").collect()] == list(np.histogram(x, 40)[0])
    wild = desc.histogram(df.union(spark.createDataFrame([(1e12,)], "x double")), "x").collect()
    assert sum(r["n"] for r in wild) == x.size + 1 and len(wild) <= x.size + 1
    h = x.std(ddof=1) * x.size ** -0.2
    for r in desc.kde(df, "x", 7).collect():
        want = np.exp(-0.5 * ((x - r["x"]) / h) ** 2).sum() / (x.size * h * math.sqrt(2 * math.pi))
        assert math.isclose(r["density"], want, rel_tol=1e-9)
    q1, q3 = np.percentile(x, [25, 75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    box = desc.box_stats(df, ["x"]).first()
    assert box["outliers"] == ((x < low) | (x > high)).sum()
    assert math.isclose(box["whisker_high"], x[x <= high].max())


def test_constant_column(spark):
    df = spark.range(5).select(F.lit(5.0).alias("x"), F.col("id").cast("double").alias("y"))
    assert desc.histogram(df, "x").first()["n"] == 5
    assert {(r["a"], r["b"]): r["r"] for r in assoc.corr_matrix(df, ["x", "y"]).collect()} == {
        ("x", "x"): None, ("x", "y"): None, ("y", "x"): None, ("y", "y"): 1.0
    }


def test_crosstab_and_rates_leave_missing_keys_out(spark):
    df = spark.createDataFrame(
        [("m", 1), ("m", 2), ("m", 1), ("f", 1), (None, 1), ("f", None)], "g string, y long"
    )
    got = {r["g"]: (r["1"], r["2"]) for r in assoc.crosstab_pct(df, "g", "y").collect()}
    assert got == {"m": (66.67, 33.33), "f": (100.0, 0.0)}
    rates = {r["g"]: (r["n"], r["rate"]) for r in assoc.rate_by(df, ["g"], F.col("y") == 1).collect()}
    assert rates == {"m": (3, 66.67), "f": (1, 100.0)}


def test_correlation_is_pairwise_complete(spark):
    rows = [(1.0, 2.0, None), (2.0, 1.0, 5.0), (3.0, 5.0, 4.0), (None, 4.0, 1.0), (5.0, 5.0, 0.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["a"], r["b"]): r["r"] for r in assoc.corr_matrix(df, ["a", "b", "c"]).collect()}
    for i, p in enumerate("abc"):
        for j, q in enumerate("abc"):
            pairs = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
            want = np.corrcoef(*zip(*pairs))[0, 1]
            assert math.isclose(got[(p, q)], want, abs_tol=1e-12)


def test_request_rows_of_more_than_a_hundred_languages(spark, tmp_path):
    from tallymark.plans.queries_ingest import request_rows

    docs = [(f"l{i % 150}" if i % 150 else None, i) for i in range(450)]
    spark.createDataFrame(docs, "lang string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in request_rows(spark, str(tmp_path)).collect()}
    assert got == {(f"l{i}" if i else None, 300.0 + i, 3) for i in range(150)}
    with pytest.raises(ing.SourceUnreadable):
        ing.to_frame(spark, spark.range(1), "k long")
