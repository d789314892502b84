"""Split, folds, weights and oversampling with more classes than the driver is given, against plain loops."""

import math

import pytest
from pyspark.sql import functions as F

from tallymark.functions.columns import hash_order
from tallymark.operators import ordering
from tallymark.operators import prepare as prep
from tallymark.plans import diagnostics as diag

CLASSES = 5000


@pytest.fixture(scope="module")
def rows(spark):
    """5,000 classes of 1 to 7 rows, one hot class and rows without a class."""
    small = spark.range(CLASSES).select(F.concat(F.lit("c"), "id").alias("label"), F.explode(F.sequence(F.lit(0), F.col("id") % 7)).alias("j"))
    hot = spark.range(9000).select(F.lit("hot").alias("label"), F.col("id").cast("int").alias("j"))
    none = spark.range(40).select(F.lit(None).cast("string").alias("label"), F.col("id").cast("int").alias("j"))
    df = small.unionByName(hot).unionByName(none).withColumn("id", F.concat_ws("-", F.coalesce("label", F.lit("?")), "j"))
    return df.select("label", "id").checkpoint() if ordering.shared_dir(spark) else df


@pytest.fixture(params=[None, 50], ids=["plain", "lowered"])
def limits(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(ordering, "LEAF_ROWS", request.param)
        monkeypatch.setattr(ordering, "SMALL_ROWS", request.param)
        monkeypatch.setattr(ordering, "settle", lambda df, bound=50, keep=ordering.settle: keep(df, 50))


def by_class(df):
    """class -> ids in hash order"""
    out = {}
    for r in df.select("label", "id", hash_order("id", 42).alias("h")).orderBy("h").collect():
        out.setdefault(r["label"], []).append(r["id"])
    return out


def test_split(rows, limits):
    groups = by_class(rows)
    given = prep.allocate({c: len(ids) for c, ids in groups.items()}, 0.2)
    got = prep.stratified_split(rows, "label", "id")
    assert got.columns == ["label", "id", "split"] and got.count() == rows.count()
    test = {r["id"] for r in got.filter("split = 'test'").collect()}
    assert test == {i for c, ids in groups.items() for i in ids[: given[c]]}
    assert len(test) == math.ceil(0.2 * rows.count())


@pytest.mark.parametrize("k", [1, 3])
def test_folds(rows, limits, k):
    expected = {}
    for ids in by_class(rows).values():
        ends = ordering.split_evenly(len(ids), k)
        for at, i in enumerate(ids):
            expected[i] = 1 + sum(at >= e for e in ends[:-1])
    got = prep.stratified_folds(rows, "label", "id", k).collect()
    assert len(got) == len(expected) and {r["id"]: r["fold"] for r in got} == expected


def test_weights(rows, limits):
    groups = by_class(rows)
    total = sum(map(len, groups.values()))
    got = prep.weigh(rows, "label").collect()
    assert len(got) == total
    assert all(math.isclose(r["class_weight"], total / (len(groups) * len(groups[r["label"]]))) for r in got)
    few = prep.weigh(rows.filter("label = 'hot' OR label IS NULL"), "label").groupBy("label").agg(F.max("class_weight")).collect()
    assert {r[0]: r[1] for r in few} == {"hot": 9040 / 18000, None: 9040 / 80}


def test_oversampling(rows, limits):
    some = rows.filter("label <> 'hot' OR label IS NULL")
    got = diag.oversample(some, "label", "id")
    times = {r["id"]: r["count"] for r in got.groupBy("id").count().collect()}
    for ids in by_class(some).values():
        assert [times[i] for i in ids] == [40 // len(ids) + (at < 40 % len(ids)) for at in range(len(ids))]
    assert got.filter("copy = 1").count() == some.count()


def test_numbers_have_no_gaps(spark, limits):
    df = spark.range(1000, numPartitions=7).select((F.col("id") * 37 % 1000).alias("v"))
    got = ordering.numbered(df, [F.desc("v")], "n").collect()
    assert all(r["n"] == 1000 - r["v"] for r in got)
    assert ordering.numbered(df.limit(0), [F.desc("v")], "n").count() == 0
