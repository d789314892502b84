import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tallymark.llm import resampling as rs

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, weight string, rank int, body string"


def words(text):
    return WORDS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))


def runs(text, longest):
    w = words(text)
    return [" ".join(w[i : i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]


def brute(docs, target, how):
    def counts(texts):
        out = [0] * how.buckets
        for t in texts:
            for f in runs(t, how.longest):
                out[zlib.crc32(f.encode()) % how.buckets] += 1
        return out

    s, t = counts(d[1] for d in docs), counts(x[0] for x in target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + how.buckets) / ((a + 1) * (sum(t) + how.buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text, *_ in docs:
        found = runs(text, how.longest)
        weight = sum(gain[zlib.crc32(f.encode()) % how.buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    may = sorted((r for r in rows if r[5] >= how.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[5], r[1], r[2]))
    for i, r in enumerate(may[: how.num * len(may) // how.den]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def tables(spark):
    rng = random.Random(12)
    vocabulary = [f"w{i}" for i in range(200)] + ["Éa", "ü", "A1", "z" * 300]
    lines = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 9))) for _ in range(60)] + ["", "  ", "- -"]
    docs = [(i, rng.choice(["\n", "\n\n", "\r\n"]).join(rng.choices(lines, k=rng.randint(0, 12))), "x", 1, "y") for i in range(150)]
    docs += [(200, None, "", 0, ""), (201, "", "", 0, ""), (202, "...\n!", None, None, None), (203, "Word, " * 30000, "", 0, "")]
    docs += [docs[5], docs[5], (None, docs[6][1], "", 0, ""), (None, docs[6][1], "", 0, ""), (7, docs[6][1] + "\nmore", "", 0, "")]
    target = [(" ".join(rng.choices(vocabulary[:60], k=30)) + "\nÉA ü", i) for i in range(20)] + [(None, 1), ("", 2)]
    return docs, target, spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(target, "text string, item_id int")


@pytest.mark.parametrize("longest, block", [(1, 1 << 20), (1, 50), (3, 1 << 20), (3, 70)])
def test_equals_brute_force(spark, monkeypatch, longest, block):
    monkeypatch.setattr(rs, "BLOCK_BYTES", block)
    docs, target, df, bench = tables(spark)
    how = rs.Sampling(longest=longest, buckets=500, num=30)
    got = rs.documents_draw(df, bench, how)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and set(dict(got.dtypes).values()) == {"bigint"}
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs, target, how)


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_lines_and_crossing_runs_make_the_whole(longest):
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice(["a", "b ", "\n", " c ", "\n\n", "d-e "]) for _ in range(rng.randint(0, 40)))
        whole = sorted(f for _, found in rs.features(text, longest) for f in found)
        lines = [f for line in text.split("\n") for _, found in rs.features(line, longest) for f in found]
        assert whole == sorted(lines + (list(rs.crossing(text, longest)) if longest > 1 else []))
        assert [f.decode() for f in whole] == sorted(runs(text, longest))


def test_each_distinct_line_is_counted_once(spark):
    docs = spark.createDataFrame([("same line\nsame line\nother",)] * 50, "text string")
    counts = rs.bucket_counts(docs, "text", rs.Sampling(buckets=10_000))
    assert counts.sum() == 250 and counts[zlib.crc32(b"line") % 10_000] == 100


def test_resample_returns_whole_rows(spark):
    docs, target, df, bench = tables(spark)
    how = rs.Sampling(buckets=500, num=30)
    drawn = rs.resample(df, bench, how)
    assert drawn.columns == df.columns
    wanted = sorted(repr(r[0]) for r in brute(docs, target, how) if r[4] is not None)
    assert sorted(repr(r.doc_id) for r in drawn.collect()) == wanted


def test_empty_tables(spark):
    docs, target, df, bench = tables(spark)
    assert rs.documents_draw(df.limit(0), bench).collect() == []
    how = rs.Sampling()
    got = sorted((tuple(r) for r in rs.documents_draw(df, bench.limit(0), how).collect()), key=repr)
    assert got == brute(docs, [], how)
    assert np.all(rs.gains(np.zeros(4, np.int64), np.zeros(4, np.int64)) == 0)
