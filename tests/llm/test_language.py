import numpy as np
import pyarrow as pa
import pytest

from tallymark.llm import language
from tallymark.llm.common import table

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, SF, "documents")
    return language.fit(docs.filter(~language.held_out(docs["doc_id"])))


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    found = language.documents_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == docs.count()
    held = [r for r in found if r.held_out]
    assert len(held) > 100 and sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_margins_are_those_of_the_feature_vector(model, monkeypatch):
    texts = ["The and attion to", "Ü", "", "a" * 9000 + " der die das", "la les des " * 500, "ES ÉÉ", None]
    model.machines = dict(model.machines)
    for long in (1 << 20, 700):
        monkeypatch.setattr(language, "_LONG", long)
        _, _ = model.predict(pa.array(texts))
        margins = {pair: np.zeros(len(texts)) for pair in model.machines}
        for k, t in enumerate(texts):
            data = np.frombuffer((t or "").encode(), np.uint8)
            model._add(margins, data, np.array([0, len(data)]), k, k + 1)
        for pair, (weights, intercept) in model.machines.items():
            direct = [language.shares((t or "").encode()) @ weights + intercept for t in texts]
            assert np.allclose(margins[pair], direct, atol=1e-3)
    single = [model.predict(pa.array([t]))[0][0] for t in texts]
    assert model.predict(pa.array(texts))[0] == single


def test_nulls_letters_and_clashing_columns(spark, model):
    rows = [(1, None, "x", 1), (2, "", "x", 1), (3, "123 !!", "x", 1), (4, "The of and tion " * 9, None, None), (4, "The of and tion " * 9, None, None), (None, "一", "x", 1)]
    out = language.predict(spark.createDataFrame(rows, "doc_id bigint, text string, lang_pred string, has_letter int"), model).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == 6 and [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert by[4].lang_pred == "en" and by[None].lang_pred in ("de", "en", "es", "fr") and by[4].has_letter is None


def test_nothing_and_one_language_to_learn(spark):
    none = spark.createDataFrame([(1, "abc", None), (2, "12", "en"), (3, None, "de")], "doc_id bigint, text string, lang string")
    model = language.fit(none)
    assert {r.lang_pred for r in language.predict(none, model).collect()} == {"und"}
    one = spark.createDataFrame([(1, "abc", "xx"), (2, "abc", "xx")], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.predict(one, language.fit(one)).collect()] == [("xx", 1.0)] * 2
    assert language.documents_languages(one.limit(0)).count() == 0


def test_the_sample_is_bounded(spark):
    df = spark.createDataFrame([(f"text {i}", "en" if i % 3 else "de") for i in range(3000)] + [("same", "fr")] * 500, "text string, lang string")
    counts = {r[0]: r[1] for r in language.sample(df, "text", "lang", 100).groupBy("lang").count().collect()}
    assert counts["fr"] == 1 and 60 < counts["en"] <= 100 and 60 < counts["de"] <= 100
