import random
import re

import numpy as np
import pytest

from tallymark.llm import jaccard
from tallymark.llm.components import components
from tallymark.llm.jaccard import Likeness, best_boundary, one_of_each, similar_documents

SCHEMA = "doc_id bigint, text string, set_id string, sketch string"
WIDE = Likeness(width=5, num=80, den=100)
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    w = WORD.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width + 1, min(len(w), 1))))


def brute(rows, like):
    """For each row (in order) its set size and the smallest key reachable."""
    sets = [shingles(r[1], like.width) for r in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and like.den * common >= like.num * (len(sets[i]) + len(sets[j]) - common):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    least = {}
    for members in groups.values():
        keys = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            least[i] = (min(keys) if keys else None) if sets[i] else rows[i][0]
    return [(rows[i][0], len(sets[i]), least[i]) for i in range(len(rows))], groups, sets


def corpus(seed):
    """Texts of all sizes with near copies, a passage that many share, exact copies, empty and null texts."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = " ".join(rng.choices(vocabulary, k=60))
    texts = [None, "", " \t ", "One", "one", "one two", "ONE TWO", "one two three"]
    for size in (*range(3, 26), 40, 80, 150, 300):
        base = rng.choices(vocabulary, k=size)
        texts.append(" ".join(base))
        for _ in range(8):
            near = list(base)
            for _ in range(rng.randint(1, max(1, size // 40))):
                at = rng.randrange(len(near))
                near[at : at + rng.randint(0, 1)] = [rng.choice(vocabulary)] if rng.random() < 0.7 else []
            texts.append(" ".join(near))
    texts += [passage + " " + " ".join(rng.choices(vocabulary, k=rng.randint(0, 12))) for _ in range(120)]
    texts += [" ".join(rng.choices(vocabulary[:12], k=rng.randint(3, 30))) for _ in range(40)]
    texts += [texts[20]] * 30
    texts.append(" ".join(rng.choices(vocabulary, k=30000)))
    rows = [(i * 3 % 1009, t, None, "s") for i, t in enumerate(texts)]
    rows += [(None, texts[30], None, "s"), (None, None, None, None), rows[9], (rows[9][0], "an entirely different text of its own", "", "")]
    return rows


@pytest.mark.parametrize("like,light,block,boundary", [(Likeness(), 64, 2048, None), (Likeness(), 3, 16, 17), (WIDE, 3, 7, 9)])
def test_components_equal_brute_force(spark, monkeypatch, like, light, block, boundary):
    if boundary:
        monkeypatch.setattr(jaccard, "best_boundary", lambda *_: boundary)
    monkeypatch.setattr(jaccard, "LIGHT", light)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = corpus(light)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(df, like=like).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, like)[0], key=repr)


def test_one_of_each(spark):
    rows = corpus(9)
    kept = one_of_each(spark.createDataFrame(rows, SCHEMA), like=WIDE).collect()
    _, groups, sets = brute(rows, WIDE)
    worded = [g for g in groups.values() if sets[g[0]]]
    assert len([r for r in kept if shingles(r.text, 5)]) == len(worded)
    assert sorted(repr((r.doc_id, r.text)) for r in kept if not shingles(r.text, 5)) == sorted(repr(rows[i][:2]) for i in range(len(rows)) if not sets[i])
    expected = []
    for g in worded:
        keys = [rows[i][0] for i in g if rows[i][0] is not None]
        expected.append(min(keys) if keys else None)
    assert sorted(map(repr, expected)) == sorted(repr(r.doc_id) for r in kept if shingles(r.text, 5))
    assert kept[0].__fields__ == ["doc_id", "text", "set_id", "sketch"]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert similar_documents(empty).count() == 0 and one_of_each(empty).count() == 0
    only_null = spark.createDataFrame([(1, None, "", "")], SCHEMA)
    assert [tuple(r)[:3] for r in similar_documents(only_null).collect()] == [(1, 0, 1)]


def test_boundary_and_subsets():
    like = Likeness()
    assert best_boundary(like, {500: 10}) < 10 and best_boundary(like, {}) == 0
    assert best_boundary(like, {n: 100 for n in range(10, 18)}) == 17
    for n in range(1, 30):
        for m in like.partners(n):
            c = like.overlap(n, m)
            assert 100 * c >= 90 * (n + m - c) and not 100 * (c - 1) >= 90 * (n + m - c + 1)


def test_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(1)
    for n in (1, 5, 63, 64, 65, 500, 3000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[: max(1, int(n * 0.9))], rng.integers(0, 2**63, max(1, n // 20), dtype=np.uint64)]))
        x, y = jaccard._sketch(a), jaccard._sketch(b)
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(jaccard._folded(x, size) ^ jaccard._folded(y, size)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, 5), (5, 1), (7, 7), (9, 1), (3, 4)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, 1: 1, 5: 1, 9: 1, 3: 3, 4: 3}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_heavy_lists_of_mixed_sizes_need_few_shingles(spark, monkeypatch):
    """A short text in a list must not blind the comparison of the long ones: only pairs near a link are verified."""
    rng = random.Random(4)
    passage = " ".join(f"p{rng.random()}" for _ in range(60))
    base = [f"b{i}" for i in range(1500)]
    texts = [passage] + [passage + " " + " ".join(f"t{t}x{i}" for i in range(1400 + 10 * t)) for t in range(12)]
    texts += [passage + " " + " ".join(base), passage + " " + " ".join([*base[:-40], *(f"c{i}" for i in range(40))])]
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    asked, verified = [], jaccard._verified

    def counted(docs, text, pairs, like):
        asked.append(pairs.count())
        return verified(docs, text, pairs, like)

    # without frequent shingles the lists of the passage are those of every text's first shingles
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    monkeypatch.setattr(jaccard, "_verified", counted)
    got = [tuple(r)[:3] for r in similar_documents(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == sorted(brute(rows, Likeness())[0])
    assert len(asked) == 2 and sum(asked) <= 2


@pytest.mark.parametrize("light,block", [(2, 2048), (2, 5)])
@pytest.mark.parametrize("like", [Likeness(), WIDE])
def test_crowds_on_either_side_of_the_threshold(spark, monkeypatch, like, light, block):
    """Sets that share a long run and end in own words of many lengths: sizes of several bands, links that one shingle decides."""
    monkeypatch.setattr(jaccard, "LIGHT", light)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "FREQUENT", 0)
    monkeypatch.setattr(jaccard, "best_boundary", lambda *_: 0)
    rng = random.Random(like.width * block)
    texts = []
    for crowd, run in enumerate((30, 61, 95, 127, 250)):
        words = [f"r{crowd}x{i}" for i in range(run)]
        for t in range(24):
            own = [f"o{crowd}x{t}x{i}" for i in range(rng.randint(0, run * 2 * (like.den - like.num) // like.den))]
            texts.append(" ".join(words[rng.randint(0, run // 12) :] + own))
    rng.shuffle(texts)
    rows = [(i, t, None, None) for i, t in enumerate(texts)]
    got = [tuple(r)[:3] for r in similar_documents(spark.createDataFrame(rows, SCHEMA).repartition(3), like=like).collect()]
    want = brute(rows, like)
    assert 5 < len(want[1]) < len(rows)
    assert sorted(got) == sorted(want[0])


def test_short_sketches_never_rule_out_a_link():
    rng = np.random.default_rng(2)
    for like in (Likeness(), WIDE, Likeness(num=40)):
        for n in (1, 5, 63, 64, 65, 130, 500, 3000):
            kept = like.overlap(n, n)
            a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            b = np.unique(np.concatenate([a[:kept], rng.integers(0, 2**63, n - kept, dtype=np.uint64)]))
            x, y = (jaccard._short(jaccard._sketch(s), len(s), like) for s in (a, b))
            size = min(len(x), len(y))
            assert len(x) <= len(jaccard._sketch(a))
            apart = int(np.bitwise_count(jaccard._folded(x, size) ^ jaccard._folded(y, size)).sum())
            assert apart <= len(np.setxor1d(a, b))
