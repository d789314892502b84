"""The pipeline's stages against brute force over the rows each of them was given."""

import pytest

import corpus_pipeline
from tallymark.llm import common
from tallymark.llm.common import saved, table
from test_decontaminate import brute as hits
from test_jaccard import shingles
from test_packing import padding

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(saved(stage(spark, out[-1], SF), name))
    return out


def test_run_goes_through_all_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "bucket", "padded_length", "batch", "place"] and out.count() > 0


def test_filters_return_rows_of_their_input(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == COLUMNS
        assert set(map(tuple, after.collect())) <= set(map(tuple, before.collect()))


def test_languages_are_kept(stages):
    assert stages[1].count() >= 0.98 * stages[0].count()


def test_quality_keeps_clean_documents(spark, stages):
    labels = table(spark, SF, "labels")
    clean = stages[1].join(labels.filter("quality = 1 and toxic = 0"), "doc_id").count()
    kept = stages[2].join(labels.filter("quality = 1 and toxic = 0"), "doc_id").count()
    assert kept >= 0.97 * clean and stages[2].count() < stages[1].count()


def test_one_of_each_group_stays(stages):
    before, after = stages[2].collect(), stages[3].collect()
    sets = {r.doc_id: shingles(r.text, 5) for r in before}
    kept = {r.doc_id for r in after}
    alike = lambda a, b: 100 * len(a & b) >= 80 * len(a | b) > 0
    for i in kept:
        assert not any(j < i and alike(sets[i], sets[j]) for j in sets)
    for i in sets.keys() - kept:
        assert any(j != i and alike(sets[i], sets[j]) for j in sets)


def test_no_benchmark_window_is_left(spark, stages):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    wanted = {r[0] for r in hits([(r.doc_id, r.text) for r in stages[3].collect()], items) if not r[5]}
    assert {r.doc_id for r in stages[4].collect()} == wanted


def test_packing_covers_every_document(stages):
    out = stages[5].collect()
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in stages[4].collect())
    ends = sorted({r.padded_length for r in out if r.n_tokens <= 8192})
    histogram = {}
    for r in out:
        if r.n_tokens <= 8192:
            histogram[r.n_tokens] = histogram.get(r.n_tokens, 0) + 1
    assert len(ends) <= 8 and sum(r.padded_length - r.n_tokens for r in out) == padding(list(histogram.items()), ends)


def test_stages_leave_other_columns_alone_and_release_broadcasts(spark):
    docs = table(spark, SMALL, "documents").selectExpr("*", "'a' AS keep", "'b' AS evidence", "'c' AS predicted_lang", "'d' AS hits")
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = saved(stage(spark, docs, SMALL), name)
        assert docs.columns == [*COLUMNS, "keep", "evidence", "predicted_lang", "hits"]
        assert docs.count() > 0 and docs.filter("keep = 'a' AND evidence = 'b' AND predicted_lang = 'c' AND hits = 'd'").count() == docs.count()
        assert len(common._shared) <= 1
    assert common.unshare() <= 1 and common.unshare() == 0
