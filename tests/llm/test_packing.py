import random
from collections import defaultdict
from itertools import combinations

from tallymark.llm.packing import bucket_lengths, pack, pack_documents


def padding(histogram, ends):
    return sum(n * (min(e for e in ends if e >= length) - length) for length, n in histogram)


def test_boundaries_have_the_least_padding():
    rng = random.Random(3)
    for _ in range(60):
        lengths = sorted(rng.sample(range(60), rng.randint(1, 9)))
        histogram = [(length, rng.randint(1, 20)) for length in lengths]
        for buckets in (1, 2, 3, 5):
            ends = bucket_lengths(histogram, buckets)
            k = min(buckets, len(lengths))
            best = min(padding(histogram, [*c, lengths[-1]]) for c in combinations(lengths[:-1], k - 1))
            assert len(ends) == k and padding(histogram, ends) == best
    assert bucket_lengths([], 4) == []


def test_batches(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice([0, 1, 3, 7, 8, 20, 21, 100, 150]), "x") for i in range(500)]
    rows += [(None, None, None), (1, -4, "y"), (9, 7, "r"), (9, 7, "r")] + [(11, 8, "z")] * 6000
    out = pack(spark.createDataFrame(rows, "id bigint, n int, batch string"), "id", "n", budget=100, buckets=3).collect()
    clean = sorted(((i is None, i or 0), max(n or 0, 0)) for i, n, _ in rows)
    assert sorted(((r.id is None, r.id or 0), r.n) for r in out) == clean
    groups = defaultdict(list)
    for r in out:
        assert r.padded_length >= r.n
        groups[r.bucket, r.batch].append(r)
    for (bucket, _), some in groups.items():
        held = len(some) * max(r.padded_length for r in some)
        assert held <= 100 or len(some) == 1 and some[0].n > 100
        assert sorted(r.place for r in some) == list(range(len(some)))
        assert bucket < 3 or some[0].n > 100
    for bucket in {b for b, _ in groups}:
        batches = sorted(k for b, k in groups if b == bucket)
        assert batches == list(range(len(batches)))
    assert pack(spark.createDataFrame([], "id bigint, n int"), "id", "n").count() == 0


def test_documents_with_nulls_and_long_texts(spark):
    rows = [(1, None), (2, ""), (3, "a b"), (4, "w " * 9000), (None, "a")]
    got = {r.doc_id: (r.n_tokens, r.bucket) for r in pack_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: 0, 2: 0, 3: 2, 4: 9000, None: 1}
    assert got[4][1] == 3


def test_keys_named_like_results(spark):
    df = spark.createDataFrame([(1, 5), (2, 6), (None, 7)], "bucket int, place int")
    out = pack(df, "bucket", "place", budget=20, buckets=2)
    assert out.columns == ["bucket", "place", "_bucket", "padded_length", "batch", "_place"]
    assert sorted((r.bucket or 0, r.place) for r in out.collect()) == [(0, 7), (1, 5), (2, 6)]
