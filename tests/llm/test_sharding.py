import zlib

from pyspark.sql import functions as F

from tallymark.llm.sharding import jump, shard_documents, shard_rows

SCHEMA = "doc_id bigint, text string, shard int, slot string"


def plain_jump(key, n):
    key, b, j = key & (1 << 64) - 1, -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) & (1 << 64) - 1
        j = int((b + 1) * (float(1 << 31) / ((key >> 33) + 1)))
    return b


def test_jump_equals_the_loop(spark):
    keys = [0, 1, -1, 7, 2**63 - 1, -(2**63), 123456789, *range(50, 400, 7)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for shards, grown in ((1, 2), (16, 17), (200, 300)):
        for r in df.select("k", jump(F.col("k"), shards, grown).alias("s")).collect():
            assert (r.s.shard, r.s.grown) == (plain_jump(r.k, shards), plain_jump(r.k, grown))


def test_documents(spark):
    rows = [(i, f"text {i} é", 9, "x") for i in range(300)] + [(None, None, 1, None), (5, "text 5 é", 9, "x"), (-3, "", 0, "y")] + [(777, "many", 0, "")] * 9000
    out = shard_documents(spark.createDataFrame(rows, SCHEMA), 16).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == sorted((r[0] is None, r[0] or 0) for r in rows)
    for r in out:
        assert r.law == "key" and r.shard == plain_jump(r.doc_id or 0, 16) and r.grown_shard in (r.shard, 16)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        data = (texts[r.doc_id] or "").encode()
        assert r.size == len(data) + 1
        assert r.text_crc32 == (None if texts[r.doc_id] is None else zlib.crc32(data))
    for s in range(16):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))


def test_empty_table_and_other_keys(spark):
    assert shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "name string, shard int")
    got = shard_rows(df, "name", 8).collect()
    assert got[0].shard == got[1].shard and all(0 <= r.shard < 8 for r in got)
