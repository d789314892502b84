import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallymark.llm import suffixes as sx

SCHEMA = "doc_id bigint, text string, spans string, kept string, digest string"


def brute(docs, length):
    texts = [(d[1] or "").encode() for d in docs]
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (doc_id, *_), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        runs = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(rng, length, n=60):
    alphabet = "abcdefgh äß\n\0"
    passage = "".join(rng.choices(alphabet, k=3 * length))
    word = lambda k: "".join(rng.choices(alphabet, k=k))
    docs = []
    for i in range(n):
        t = word(rng.randint(0, 4 * length))
        for _ in range(rng.randint(0, 2)):
            lo, size = rng.randrange(len(passage)), rng.randint(length // 2, 2 * length)
            at = rng.randint(0, len(t))
            t = t[:at] + passage[lo : lo + size] + t[at:]
        docs.append((i, t, "x", "y", "z"))
    whole = docs[3][1] + word(length)
    docs += [(100, None, "", "", ""), (101, "", "", "", ""), (102, "a" * (length + 1), "", "", ""), (103, "b" * length, "", "", "")]
    docs += [(104, "ab" * length, "", "", ""), (105, whole, "", "", ""), (106, whole, "", "", ""), (None, whole, None, None, None)]
    docs += [(107, whole[:-5] + "!" + whole[-4:], "", "", ""), (108, word(3 * length) * 2, "", "", ""), (109, "\0" * (length // 2) + passage[:length] + "\0", "", "", "")]
    # strings that differ in the first or last byte only
    stem = word(length - 1)
    docs += [(110, "1" + stem + "x", "", "", ""), (111, "2" + stem + "x", "", "", ""), (112, "3" + stem + "y", "", "", "")]
    return docs


def run(spark, docs, length):
    cut = sx.without_repeats(spark.createDataFrame(docs, SCHEMA).repartition(4), length=length)
    assert cut.columns == ["doc_id", "text", "digest", "spans", "kept"]
    out = []
    for r in cut.collect():
        data = (r.text or "").encode()
        out.append((r.doc_id, len(data), sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("length, seed, block, part", [(200, 1, 1 << 16, 1 << 20), (200, 2, 900, 500), (30, 3, 1 << 16, 64), (12, 4, 100, 1 << 20)])
def test_equals_brute_force(spark, monkeypatch, length, seed, block, part):
    monkeypatch.setattr(sx, "BLOCK_BYTES", block)
    monkeypatch.setattr(sx, "SLICE_BYTES", part)
    monkeypatch.setattr(sx, "LONGEST", max(length, block // 4))
    docs = corpus(random.Random(seed), length)
    assert run(spark, docs, length) == brute(docs, length)


def test_runs_over_many_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        docs = corpus(random.Random(7), 40, 25)
        assert run(spark, docs, 40) == brute(docs, 40)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_large_sides_are_joined_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sx, "BROADCAST_RANGES", 0)
    docs = corpus(random.Random(9), 40)
    assert run(spark, docs, 40) == brute(docs, 40)


def test_query_columns_and_small_tables(spark):
    docs = corpus(random.Random(5), 200, 10)
    got = sx.documents_repeats(spark.createDataFrame(docs, SCHEMA))
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, 200)
    assert sx.documents_repeats(spark.createDataFrame([], SCHEMA)).collect() == []
    alone = [(1, "short", "", "", ""), (2, None, "", "", "")]
    assert sorted(tuple(r) for r in sx.documents_repeats(spark.createDataFrame(alone, SCHEMA)).collect()) == brute(alone, 200)


def test_stretches_do_not_depend_on_parts(monkeypatch):
    rng = random.Random(3)
    texts = pa.array(["".join(rng.choices("ab", k=rng.randint(0, 300))) for _ in range(20)] + [None, "a" * 400])
    whole = [x.tolist() for x in sx.stretches(texts, 16)]
    monkeypatch.setattr(sx, "SLICE_BYTES", 37)
    assert [x.tolist() for x in sx.stretches(texts, 16)] == whole


def test_long_runs_are_counted_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(sx, "LONG_RUN", 2)
    docs = corpus(random.Random(11), 60)
    assert run(spark, docs, 60) == brute(docs, 60)


@pytest.mark.parametrize("length", [8, 12, 25, 30, 43, 44, 60, 128, 200, 1000])
def test_covers(length):
    """Any two places have sampled ones equally far behind, and a string of `length` bytes holds the names of the last level."""
    c = sx.Cover.of(length)
    for i in range(c.period):
        for j in range(c.period):
            assert any((i + d) % c.period in c.sampled and (j + d) % c.period in c.sampled for d in range(c.period))
    cover = c.first
    for one, two in c.steps:
        assert one % c.period == two % c.period == 0 and one <= cover and two - one <= cover
        cover += two
    assert cover == c.last <= length - c.period + 1 and c.last > length - 2 * c.period - 2


def test_merged_ranges():
    a, b = sx.merged(np.array([5, 0, 2, 9]), np.array([6, 2, 4, 10]))
    assert a.tolist() == [0, 5, 9] and b.tolist() == [4, 6, 10]
