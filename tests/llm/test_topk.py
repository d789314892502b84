import math
import random

import numpy as np

from tallymark.llm import topk
from tallymark.llm.topk import top_k

SCHEMA = "vec_id bigint, embedding array<float>, label int, score int, x int"


def brute(rows, k, every):
    """Every row but the query's own, copies included; the rows of one query id share its places."""
    usable = []
    for vec_id, v, *_ in rows:
        if vec_id is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        usable.append((vec_id, [math.floor(64 * float(np.float32(c))) for c in v]))
    out = []
    for q in sorted({i for i, _ in usable if i % every == 0}):
        own = [x for i, x in usable if i == q]
        scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for x in own for i, y in usable if i != q and len(y) == len(x))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=20, every=20):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(tuple(r) for r in top_k(df, df.filter(f"vec_id % {every} = 0"), k).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 90)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(topk, "PILOT", 40)
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)], 0, 1, 2) for i in range(600)]
    rows += [(600 + i, [0.5, 0.25] * 4, 0, 1, 2) for i in range(150)]  # ties
    rows += [(1000, None, 0, 0, 0), (1020, [], 0, 0, 0), (1040, [1.0] * 7 + [None], 0, 0, 0), (1060, [float("nan")] * 8, 0, 0, 0)]
    rows += [(1080, [float("inf")] * 8, 0, 0, 0), (None, [1.0] * 8, 0, 0, 0), rows[40], (1100, [9.0, -9.0, 3.0], 0, 0, 0), (1101, [1.0, 1.0, 1.0], 0, 0, 0)]
    assert run(spark, rows) == brute(rows, 20, 20)


def test_few_and_no_candidates(spark):
    rows = [(0, [1.0, -1.0], 0, 0, 0), (3, [2.0, 0.5], 0, 0, 0), (-20, [0.1, 0.1], 0, 0, 0)]
    assert run(spark, rows) == brute(rows, 20, 20)
    assert run(spark, rows[:1]) == [] and run(spark, []) == []


def test_tree_visits_only_what_it_must():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16)) * 50
    rows = np.floor(centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 16)))
    search = topk.Search(np.array([-1]), np.floor(centres[:1]), 5, np.full(1, -np.inf))
    seen = []
    leaf = search._leaf
    search._leaf = lambda active, ids, r: (seen.append(len(ids)), leaf(active, ids, r))
    search.visit(topk.BallTree(np.arange(4000), rows.copy()))
    scores = np.sort(rows @ np.floor(centres[0]))[::-1][:5]
    assert sorted(search.scores[0], reverse=True) == scores.tolist() and sum(seen) < 2000


def every_row(rows, k, every):
    """The SQL on different rows, in whole numbers."""
    xs = sorted({(i, tuple(math.floor(64 * float(np.float32(c))) for c in v)) for i, v, *_ in rows})
    out = []
    for q in sorted({i for i, _ in xs if i % every == 0}):
        pairs = sorted((-sum(map(int.__mul__, a, b)), i) for p, a in xs if p == q for i, b in xs if i != q)
        out += [(q, r + 1, i, -s if -(1 << 63) <= -s < 1 << 63 else None) for r, (s, i) in enumerate(pairs[:k])]
    return out


def test_large_components_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 90)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(topk, "PILOT", 40)
    monkeypatch.setattr(topk, "LEAF", 16)
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 1) * 10 ** rng.choice([0, 0, 3, 6, 7]) for _ in range(8)], 0, 1, 2) for i in range(300)]
    rows += [(300 + i, [float(rng.choice([-1, 1]) * 2**22 + rng.randint(0, 3)) for _ in range(8)], 0, 1, 2) for i in range(200)]  # close scores beyond 2^53
    rows += [(i, [rng.gauss(0, 1e6) for _ in range(8)], 0, 1, 2) for i in range(0, 60, 3)]  # ids with two vectors, some of them queries
    assert run(spark, rows) == every_row(rows, 20, 20)
    rows += [(1000 + i, [s * rng.uniform(1, 3) * 10.0 ** rng.choice([12, 30, 37]) for s in (1, -1, 1, 1, -1, 1, 1, 1)], 0, 1, 2) for i in range(60)]  # scores beyond 2^63
    key = lambda r: r[:3]
    assert sorted(run_unsorted(spark, rows), key=key) == sorted(every_row(rows, 20, 20), key=key)


def run_unsorted(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return [tuple(r) for r in top_k(df, df.filter("vec_id % 20 = 0"), 20).collect()]


def test_every_copy_of_a_row_counts(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD_ROWS", 90)
    monkeypatch.setattr(topk, "BLOCK_QUERIES", 7)
    monkeypatch.setattr(topk, "PILOT", 40)
    rng = random.Random(6)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)], 0, 1, 2) for i in range(200)]
    for i in range(200):
        rows += [rows[i]] * rng.choice([0, 0, 1, 3, 40])
    rows += [(7, [3.0] * 6, 0, 1, 2)] * 5 + [(20, [2.0] * 6, 0, 1, 2)] * 300
    assert run(spark, rows) == brute(rows, 20, 20) and run(spark, rows, k=3) == brute(rows, 3, 20)
