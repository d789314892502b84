import hashlib
import random
import re

import pyarrow as pa
import pytest

from tallymark.llm import decontaminate as d

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, items string, n_words string"


def words(text):
    return WORDS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def brute(docs, items):
    out = []
    for doc_id, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item, t in items:
            x = words(t)
            k = min(len(x), 10)
            wanted = {tuple(x[i : i + k]) for i in range(len(x) - k + 1)} if k else set()
            for i in range(len(w) - k + 1):
                if k and tuple(w[i : i + k]) in wanted:
                    hit.update(range(i, i + k))
                    found.add(str(item))
        out.append((doc_id, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def tables(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(300)] + ["ä", "Été", "x1"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(11, 40)))) for i in range(12)]
    items += [(50, "Only three words"), (51, ""), (52, None), (53, items[3][1]), (54, "one-two, THREE"), (None, "a null id of five")]
    docs = []
    for i in range(80):
        w = rng.choices(vocabulary, k=rng.randint(0, 60))
        if i % 3 == 0:
            x = words(items[i % 12][1])
            lo = rng.randrange(len(x))
            w[len(w) // 2 : len(w) // 2] = x[lo : lo + rng.randint(5, 40)]
        docs.append((i, rng.choice([" ", ", ", " - "]).join(w).upper() if i % 2 else " ".join(w), "x", "y"))
    docs += [(100, None, "", ""), (101, "", "", ""), (102, "only THREE words, only three words!", "", ""), (103, "one two three", None, None)]
    docs += [(104, ("z " * 20000 + items[0][1] + " z" * 20000), "", ""), docs[3], (None, items[1][1] + " " + items[1][1], "", "")]
    return docs, items, spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id bigint, text string")


@pytest.mark.parametrize("block", [200_000, 60])
def test_hits_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(d, "BLOCK_WINDOWS", block)
    docs, items, df, bench = tables(spark)
    named = [(i, t) for i, t in items if i is not None]
    got = sorted((tuple(r) for r in d.documents_hits(df, bench.filter("item_id is not null")).collect()), key=repr)
    assert got == brute(docs, named)


def test_a_false_hash_is_not_a_hit():
    index = d.Index([("a b", 2, ["1"])])
    assert index.find(pa.array(["x A-b y"]))[1:] == ([[(1, 3)]], [{"1"}])
    (where,) = index.items
    index.items[where] = {b"c d": ["1"]}
    assert index.find(pa.array(["x a b y"]))[1:] == ([[]], [set()])


def test_removal(spark):
    docs, items, df, bench = tables(spark)
    hit = {(r[0], r[2] > 0) for r in brute(docs, [(i if i is not None else "n", t) for i, t in items])}
    kept = d.decontaminate(df, bench)
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(i) for i, *_ in docs if (i, False) in hit and (i, True) not in hit)
    assert kept.columns == df.columns
    cut = d.decontaminate(df, bench, remove="spans")
    assert cut.count() == len(docs)
    assert all(r.n_hit == 0 for r in d.documents_hits(cut, bench).collect())
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[102] == "!" and texts[103] == "" and texts[101] == "" and texts[100] is None
    with pytest.raises(ValueError):
        d.decontaminate(df, bench, remove="words")


def test_empty_tables(spark):
    docs, _, df, bench = tables(spark)
    none = d.documents_hits(df, bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(r.contaminated for r in none)
    assert d.documents_hits(df.limit(0), bench).count() == 0


def test_spans_of_a_benchmark_of_several_blocks(spark, monkeypatch):
    docs, _, df, bench = tables(spark)
    whole = sorted(map(repr, d.decontaminate(df, bench, remove="spans").collect()))
    monkeypatch.setattr(d, "BLOCK_WINDOWS", -(-d.benchmark_windows(bench, "item_id", "text", d.WIDTH).count() // 3))
    cut = d.decontaminate(df, bench, remove="spans")
    assert cut.columns == df.columns and sorted(map(repr, cut.collect())) == whole


def test_columns_named_like_results_come_back(spark):
    docs, items, _, bench = tables(spark)
    df = spark.createDataFrame([(d[0], d[1], i, -i) for i, d in enumerate(docs)], "hits bigint, items string, n_words int, own_hits int")
    kept = d.decontaminate(df, bench, text="items")
    assert kept.columns == df.columns and set(map(tuple, kept.collect())) <= set(map(tuple, df.collect())) and 0 < kept.count() < df.count()
