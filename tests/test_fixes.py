"""Cases that once gave wrong answers or crashed."""

import math

import pytest
from pyspark.ml import PipelineModel

from tallymark import session
from tallymark.operators.features import MedianImputer, RobustScale, YeoJohnson
from tallymark.operators.models import MajorityClass
from tallymark.operators.ordering import head, most_frequent, order_stats, outer_align, top_k
from tallymark.operators.quality import null_profile
from tallymark.plans import selection
from tallymark.plans.scoring import cached_model
from tallymark.session import scratch_path
from tallymark.sources.ingest import ArtifactMissing, apply_casts, save_artifact
from tallymark.streaming import scoring as live

BIG = 9007199254740993
NAN = float("nan")


def test_integers_keep_64_bits(spark):
    df = spark.createDataFrame([(str(BIG), BIG, 65.0, "65.0"), ("65.5", -BIG, 65.5, " 62.0 "), ("x", None, NAN, "")], "t string, b bigint, d double, s string")
    out = [tuple(r) for r in apply_casts(df, dict.fromkeys("tbds", "bigint")).collect()]
    assert out == [(BIG, BIG, 65, 65), (None, -BIG, None, 62), (None, None, None, None)]


def test_nan_is_missing_when_learning(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (NAN,), (NAN,), (NAN,), (None,)], "x double")
    assert MedianImputer(["x"]).fit(df).getOrDefault("medians") == [2.0]
    scale = RobustScale(["x"]).fit(df)
    assert scale.getOrDefault("centers") == [2.0] and scale.getOrDefault("scales") == [1.0]
    clean = df.filter("not isnan(x)")
    assert YeoJohnson(["x"]).fit(df).getOrDefault("lambdas") == YeoJohnson(["x"]).fit(clean).getOrDefault("lambdas")
    (row,) = order_stats(df, ["x"], [0.5]).collect()
    assert (row["count"], row["max"]) == (3, 3.0)


def test_nothing_to_learn_a_scale_from(spark):
    with pytest.raises(ValueError, match="no value to learn a scale"):
        RobustScale(["x"]).fit(spark.createDataFrame([(None,), (NAN,)], "x double"))


def test_modes_of_mixed_types(spark):
    df = spark.createDataFrame([("a", BIG, 1.5), ("b", BIG + 1, 1.5), ("a", BIG + 1, 2.5)], "s string, b bigint, d double")
    assert {r["column"]: r["value"] for r in most_frequent(df, ["s", "b", "d"]).collect()} == {"s": "a", "b": str(BIG + 1), "d": "1.5"}
    assert {r["column"]: r["value"] for r in most_frequent(df, ["b", "d"]).collect()} == {"b": float(BIG + 1), "d": 1.5}


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1, None), (2, 3)], "`a.b` int, c int")
    assert [tuple(r)[:2] for r in null_profile(df).collect()] == [("c", 1)]


def test_streams_read_only_their_path(spark):
    base = scratch_path(spark, "stream")
    spark.range(3).coalesce(1).write.parquet(f"{base}/ev")
    spark.range(100, 105).write.parquet(f"{base}/ev_old")
    name = next(r[0] for r in spark.read.parquet(f"{base}/ev").selectExpr("input_file_name()").collect())
    for path in (f"{base}/ev", name):
        sink = scratch_path(spark, "sink")
        stream = live.read_parquet_stream(spark, path, spark.read.parquet(f"{base}/ev").schema)
        live.write_stream(stream, sink, scratch_path(spark, "log")).awaitTermination()
        assert sorted(r.id for r in spark.read.parquet(sink).collect()) == [0, 1, 2]


def test_undefined_metrics_stay_undefined():
    assert selection._mean([None, 0.5, 1.0]) == 0.75 and selection._mean([None]) is None


def test_cached_model_follows_the_files(spark):
    path = scratch_path(spark, "model")
    with pytest.raises(ArtifactMissing):
        cached_model(path)
    seen = []
    for label in (0, 1):
        rows = spark.createDataFrame([(label,)], "label int")
        save_artifact(PipelineModel([MajorityClass().fit(rows)]), {"n": label}, path)
        assert cached_model(path) is cached_model(path)
        seen.append(cached_model(path).transform(rows).first()["prediction"])
    assert seen == [0, 1]


def test_a_cluster_must_name_its_shared_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_intermediate_tables_can_be_cleared(spark):
    path = scratch_path(spark, "layer")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert session.clear_scratch(spark) > 0 and session.clear_scratch(spark) == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_top_head_and_outer_align(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0), (None, 6.0)], "k int, v double")
    assert [r.k for r in top_k(df, 2, ["v"]).collect()] == [3, None]
    assert [r.k for r in head(df, 9, ["k"]).collect()] == [1, 2, 3, None]
    other = spark.createDataFrame([(3, 1.0), (4, 2.0), (None, 3.0)], "k int, v double")
    got = {r.k: (r.a, r.b) for r in outer_align({"a": df, "b": other}, ["k"], "v").collect()}
    assert got == {1: (5.0, None), 2: (None, None), 3: (7.0, 1.0), 4: (None, 2.0), None: (6.0, 3.0)}
    assert not math.isnan(got[1][0])
