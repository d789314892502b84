"""Malformed CSV rows and stream rows outside the contract are set aside, with the reason and exactly once."""

import math

import pytest
from pyspark.ml import PipelineModel

from tallymark.operators.models import Scorecard
from tallymark.sources import ingest as ing
from tallymark.spec import Bound, TableSpec
from tallymark.streaming import scoring as live

SPEC = TableSpec(columns=("a", "c"), casts={}, target="c", target_map={})


def written(tmp_path, *lines):
    (tmp_path / "one.csv").write_text("a,b,c\n" + "\n".join(lines) + "\n")
    return str(tmp_path / "one.csv")


def test_malformed_lines(spark, tmp_path):
    lines = ["1,x,y", '2,"x, ""y""",z', "3,x", "4,x,y,z", '5,"x,y', "6,,", '7,"",NA', "é,ß,日本", "4,x,y,z", '8,x,"' + "q" * 50_000 + '"']
    good, bad = ing.read_csv_checked(spark, written(tmp_path, *lines), SPEC)
    assert sorted(map(tuple, good.collect()), key=repr) == sorted(
        [("1", "y"), ("2", "z"), ("6", None), ("7", None), ("é", "日本"), ("8", "q" * 50_000)], key=repr
    )
    assert sorted(map(tuple, bad.collect())) == [
        ("3,x", "too few cells"), ("4,x,y,z", "too many cells"), ("4,x,y,z", "too many cells"), ('5,"x,y', "open quote")
    ]
    assert good.columns == ["a", "c"] and bad.columns == ["line", "problem"]


def test_strict_reading_fails_on_the_first_malformed_line(spark, tmp_path):
    path = written(tmp_path, "1,x,y", "3,x")
    with pytest.raises(Exception, match="too few cells: 3,x"):
        ing.read_csv_checked(spark, path, SPEC, strict=True)[0].collect()
    good, _ = ing.read_csv_checked(spark, written(tmp_path, "1,x,y", "2,,"), SPEC, strict=True)
    assert good.count() == 2


def test_empty_files_missing_files_and_a_column_named_line(spark, tmp_path):
    good, bad = ing.read_csv_checked(spark, written(tmp_path), SPEC)
    assert good.count() == bad.count() == 0
    with pytest.raises(ing.SourceMissing):
        ing.read_csv_checked(spark, str(tmp_path / "no.csv"), SPEC)
    (tmp_path / "two.csv").write_text("line,c\n1,2\n1\n")
    good, bad = ing.read_csv_checked(spark, str(tmp_path / "two.csv"), TableSpec(columns=("line",), casts={}, target="c", target_map={}))
    assert [tuple(r) for r in good.collect()] == [("1",)] and [tuple(r) for r in bad.collect()] == [("1", "too few cells")]


CARD = TableSpec(
    columns=("id", "x", "kind"), casts={}, target="kind", target_map={}, regular=("x",), categorical=("kind",),
    bounds={"x": Bound(0.0, 9.0)}, domains={"kind": ("a", "b")},
)
ROWS = [(1, 1.0, "a"), (2, 10.0, "c"), (3, -1.0, "a"), (4, None, None), (5, 9.0, "b"), (5, 9.0, "b")]


def run(spark, tmp_path, log, files=None):
    stream = live.read_parquet_stream(spark, str(tmp_path / "in"), "id int, x double, kind string", files)
    sink, aside = str(tmp_path / "sink"), str(tmp_path / "aside")
    model = PipelineModel([Scorecard({"x": 0.5}, -2.0)])
    live.score_checked_stream(model, stream, CARD, sink, aside, str(tmp_path / log), {1: "yes", 0: "no"}).awaitTermination()
    return live.read_batches(spark, sink), live.read_batches(spark, aside)


def test_rejected_rows_carry_reasons_and_replays_write_nothing_twice(spark, tmp_path):
    spark.createDataFrame(ROWS, "id int, x double, kind string").write.parquet(str(tmp_path / "in"))
    for log in ("log", "log", "again"):  # a run, a restart with nothing new, and the first batch once more
        scored, rejected = run(spark, tmp_path, log)
        got = sorted((r["id"], round(r["score"], 9), r["predicted"], r["predicted_label"]) for r in scored.collect())
        p = lambda m: round(1 / (1 + math.exp(-m)), 9)
        assert got == [(1, p(-1.5), 0, "no"), (4, p(-2.0), 0, "no"), (5, p(2.5), 1, "yes"), (5, p(2.5), 1, "yes")]
        assert {r["id"]: r["broken_rules"] for r in rejected.collect()} == {2: ["x <= 9", "kind in ['a', 'b']"], 3: ["x >= 0"]}


def test_new_files_are_batches_of_their_own(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id int, x double, kind string")
    for i, part in enumerate([df.filter("id < 3"), df.filter("id >= 3")]):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        scored, rejected = run(spark, tmp_path, "log")
    assert scored.count() == 4 and rejected.count() == 2
    assert spark.read.parquet(str(tmp_path / "sink")).select("batch").distinct().count() == 2


def test_absent_columns_and_saved_scorecards(spark, tmp_path):
    stream = live.read_parquet_stream(spark, str(tmp_path), "id int, x double")
    with pytest.raises(ing.SourceUnreadable):
        live.score_checked_stream(PipelineModel([Scorecard()]), stream, CARD, "s", "r", "c")
    ing.save_artifact(PipelineModel([Scorecard({"x": 0.5}, 1.0)]), {}, str(tmp_path / "model"))
    model, _ = ing.load_artifact(spark, str(tmp_path / "model"))
    row = model.transform(spark.createDataFrame([(2.0,)], "x double")).first()
    assert row["prediction"] == 1.0 and math.isclose(row["probability"][1], 1 / (1 + math.exp(-2.0)))
