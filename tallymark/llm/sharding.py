"""Sharding by jump consistent hashing.

Lamping and Veach's jump hash needs no table of the ring: from a key it draws a rising sequence of shard numbers, and with n shards
the key belongs to the last number below n. One more shard therefore takes rows only into itself, 1/(n+1) of all.
All steps are column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.llm.common import numbered

#: The multiplier of the published generator, a fixed value: key = key * 2862933555777941757 + 1 modulo 2^64.
MULTIPLIER = 2862933555777941757
#: Draws made for every key; a key that needs more (one in many billions) goes on for as long as it must.
USUAL_STEPS = 64

_WORD = (1 << 32) - 1


def _times(hi: Column, lo: Column) -> tuple[Column, Column]:
    """(hi, lo) * MULTIPLIER + 1 modulo 2^64 in 32-bit halves, without an overflow of the 64-bit arithmetic."""
    word, half = F.lit(_WORD), F.lit(0xFFFF)
    mul_hi, mul_lo = MULTIPLIER >> 32, MULTIPLIER & _WORD
    upper, lower = F.lit(mul_lo >> 16), F.lit(mul_lo & 0xFFFF)

    def low_product(x: Column) -> tuple[Column, Column]:
        a, b = x * lower, x * upper
        return a + F.shiftleft(b.bitwiseAND(half), 16), F.shiftright(b, 16)

    first, carry = low_product(lo)
    first = first + F.lit(1)
    top, _ = low_product(hi)
    new_hi = F.shiftright(first, 32) + carry + (lo * F.lit(mul_hi)).bitwiseAND(word) + top.bitwiseAND(word)
    return new_hi.bitwiseAND(word), first.bitwiseAND(word)


def jump(key: Column, shards: int, grown: int | None = None) -> Column:
    """A struct (shard, grown): the shard of a 64-bit key with `shards` shards and with `grown` shards (at least as many)."""
    if shards < 1 or (grown is not None and grown < shards):
        raise ValueError("shards must be at least 1 and grown at least shards")
    most = grown or shards
    start = F.struct(
        F.lit(0).cast("bigint").alias("j"),
        F.shiftrightunsigned(key, 32).alias("hi"),
        key.bitwiseAND(F.lit(_WORD)).alias("lo"),
        F.lit(0).cast("bigint").alias("shard"),
        F.lit(0).cast("bigint").alias("grown"),
    )

    def step(s: Column, _: Column) -> Column:
        hi, lo = _times(s["hi"], s["lo"])
        share = F.lit(2147483648.0) / (F.shiftright(hi, 1) + F.lit(1)).cast("double")
        j = ((s["j"] + F.lit(1)).cast("double") * share).cast("bigint")
        return F.when(s["j"] >= most, s).otherwise(
            F.struct(
                j.alias("j"), hi.alias("hi"), lo.alias("lo"),
                F.when(s["j"] < shards, s["j"]).otherwise(s["shard"]).alias("shard"), s["j"].alias("grown"),
            )
        )

    # each draw is larger than the last, so `most` draws always suffice
    state = F.aggregate(F.sequence(F.lit(1), F.lit(min(most, USUAL_STEPS))), start, step)
    if most > USUAL_STEPS:
        rest = F.sequence(F.lit(1), F.lit(most - USUAL_STEPS))
        state = F.aggregate(F.when(state["j"] < most, rest).otherwise(F.slice(rest, 1, 0)), state, step)
    return F.struct(state["shard"].cast("int").alias("shard"), state["grown"].cast("int").alias("grown"))


def key_of(column: Column, kind: str) -> Column:
    """The 64-bit key of a value: an integer itself, anything else its 64-bit hash; a null has key 0."""
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return F.coalesce(column.cast("bigint") if whole else F.xxhash64(column), F.lit(0).cast("bigint"))


def shard_rows(df: DataFrame, key: str, shards: int, out: str = "shard", grown: str | None = None) -> DataFrame:
    """`df` with the shard of each row, and as `grown` the shard it has once there is one more.

    No row moves: the key alone decides, so equal keys share a shard and repeated rows stay together. A null key counts as key 0.
    Columns of `df` that have the names of the results are replaced. An empty table gives an empty table.
    """
    state = jump(key_of(F.col(f"`{key}`"), dict(df.dtypes)[key]), shards, shards + 1 if grown else None)
    marked = df.withColumns({out: state["shard"]} | ({grown: state["grown"]} if grown else {}))
    return marked


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    size is the text's UTF-8 bytes plus 1 (a null text: 1, with a null CRC-32; an empty one: 1, with CRC-32 0). slot numbers the
    rows of a shard without gaps. Other columns of `docs` are not read; equal rows get different slots. Only these digests are
    shuffled, never the texts.
    """
    digest = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32("text").alias("text_crc32"),
    )
    placed = numbered(shard_rows(digest, "doc_id", shards, grown="grown_shard"), "shard", ["doc_id", "text_crc32", "size"], "slot")
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


SQL = """
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
bytes AS (
  SELECT rowid AS r, doc_id, text IS NULL AS missing, octet_length(encode(coalesce(text, ''))) AS n,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT) AS b
  FROM (SELECT row_number() OVER () AS rowid, doc_id, text FROM documents)
), digest AS (
  SELECT r, doc_id, n + 1 AS size, CASE WHEN missing THEN NULL ELSE
    xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), 4294967295::BIGINT), 4294967295) END AS crc
  FROM bytes, crc_table
), jump(r, j, key, a, b) AS (
  SELECT r, 0::BIGINT, (CASE WHEN coalesce(doc_id, 0) < 0 THEN doc_id::HUGEINT + 18446744073709551616 ELSE coalesce(doc_id, 0) END)::UHUGEINT,
    0::BIGINT, 0::BIGINT FROM digest
  UNION ALL
  SELECT r, trunc((j + 1) * (2147483648.0::DOUBLE / ((nk // 8589934592)::BIGINT + 1)::DOUBLE))::BIGINT, nk, CASE WHEN j < 16 THEN j ELSE a END, j
  FROM (SELECT *, (key * 2862933555777941757::UHUGEINT + 1) % 18446744073709551616::UHUGEINT AS nk FROM jump WHERE j < 17)
), placed AS (
  SELECT doc_id, size, crc, a::INT AS shard, b::INT AS grown
  FROM digest JOIN (SELECT r, a, b FROM jump WHERE j >= 17) USING (r)
)
SELECT doc_id, size::BIGINT AS size, crc AS text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 3), doc_id NULLS FIRST, crc NULLS FIRST, size) - 1 AS slot,
  grown AS grown_shard
FROM placed
"""
