"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets.

Equal sets are one set from the start. A link between two different sets is found in one of two ways, by the smaller size:

* *Small sets* (size up to a boundary): for every size pair, all subsets of the fixed size that the two must share are
  enumerated; a shared subset proves the link.
* *Large sets*: inverted lists over the first shingles of each set in one global order, just so many that linked sets share one
  (very frequent shingles come last in the order). Each list is scanned from its hub; light lists that a scan leaves
  unconnected are compared pair by pair across components, heavy lists by short bit sketches, the longest of them by bands of
  sizes and in blocks.

The boundary is the one with the least cost over the histogram of sizes. Candidates pass a lossless filter (parity sketches: their
distance is never larger than the sets' difference) and are then verified on the shingles themselves.

Shingles and sets are known by 64-bit hashes: with N different sets about N^2 / 2^65 pairs are expected to collide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm.common import forget, fresh, saved, share
from tallymark.llm.components import components
from tallymark.llm.words import SPACED, hash_words, mix, slices, windows

#: Lists of at most so many sets are light.
LIGHT = 8
#: Sets that are compared with each other at once in a heavy list; longer lists are cut into bands and blocks.
BLOCK = 2048
#: Pairs of a heavy list that are gathered before their sketches are compared, and bytes of sketches unpacked at once.
GATHERED = 200_000
UNPACKED = 4 << 20
#: Shingles that count as very frequent, at most (8 bytes each are broadcast); any choice gives the same links.
FREQUENT = 262_144
#: Occurrences within one piece of a batch from which a shingle is reported as perhaps frequent.
REPORTED = 2
REPORT_BYTES = 4 << 20
#: Small sizes that are considered as the boundary.
SMALLEST_LARGE = 40
#: Set ids that may be broadcast (16 bytes each) once they have been counted.
BROADCAST_IDS = 500_000


@dataclass(frozen=True)
class Likeness:
    """Sets link when den * |intersection| >= num * |union|; shingles have `width` words."""

    width: int = 3
    num: int = 90
    den: int = 100

    def overlap(self, n: int, m: int) -> int:
        return -(-self.num * (n + m) // (self.num + self.den))

    def partners(self, n: int) -> range:
        return range(-(-self.num * n // self.den), self.den * n // self.num + 1)

    def prefix(self, n: int) -> int:
        return n - -(-self.num * n // self.den) + 1

    def short(self, n: int) -> int:
        """Bits of a short sketch (a power of two): enough to put unrelated sets at about twice the distance that a link allows."""
        return 1 << max(6, (8 * (n - self.overlap(n, n)) - 1).bit_length())


@cache
def _left_out(n: int, kept: int) -> np.ndarray:
    """For each subset of `kept` of n things, the places of those left out."""
    return np.array(list(combinations(range(n), n - kept)), np.int64).reshape(comb(n, kept), n - kept)


def _tags(like: Likeness, n: int, boundary: int) -> list[tuple[int, int, int]]:
    """(smaller size, larger size, shared size) of the pairs in which a set of size n takes part as small."""
    pairs = [(min(n, m), max(n, m), like.overlap(n, m)) for m in like.partners(n)]
    return [(lo, hi, c) for lo, hi, c in pairs if lo <= boundary and c <= lo and not (lo == hi == c)]


def best_boundary(like: Likeness, sizes: dict[int, int]) -> int:
    """The boundary of least cost: enumerated subsets for small sets; for large ones list entries and shingles fetched to verify."""

    def cost(x: int) -> int:
        return sum(
            rows * (sum(comb(n, c) for _, _, c in _tags(like, n, x)) + (like.prefix(n) + n if n > x else 0))
            for n, rows in sizes.items()
        )

    return min(range(SMALLEST_LARGE), key=cost)


def _sets(piece: pa.RecordBatch, text: str, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The sorted shingle hashes of each row, and the 64-bit ids of the sets (0 for an empty set)."""
    hashes, first = hash_words(piece.column(text), SPACED)
    found, sets = windows(hashes, width), []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= width:
            sets.append(np.unique(found[lo : hi - width + 1]))
        else:
            sets.append(windows(hashes[lo:hi], hi - lo) if hi > lo else found[:0])
    sizes = np.array([len(s) for s in sets], np.int64)
    ids = np.zeros(len(sets), np.uint64)
    full = sizes > 0
    if full.any():
        starts = (np.cumsum(sizes) - sizes)[full]
        sums = np.add.reduceat(mix(np.concatenate(sets) + np.uint64(0x9E37)), starts)
        ids[full] = mix(sums + sizes[full].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return sets, ids


def _sketch(shingles: np.ndarray) -> bytes:
    """Parities of the shingles by their low bits, in at least twice as many bits (a power of two) as there are shingles.

    With fewer bits the sketches of sets that just miss the threshold come too near, and their shingles are fetched in vain.
    """
    bits = max(64, 1 << (2 * len(shingles) - 1).bit_length())
    counts = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def _folded(sketch: bytes, size: int) -> np.ndarray:
    return np.bitwise_xor.reduce(np.frombuffer(sketch, np.uint8).reshape(-1, size), axis=0)


def _short(sketch: bytes, n: int, like: Likeness) -> bytes:
    return _folded(sketch, min(len(sketch), like.short(n) // 8)).tobytes()


def digests(docs: DataFrame, key: str, text: str, like: Likeness) -> tuple[DataFrame, DataFrame]:
    """(key, set_id, n_shingles, sketch, short_sketch) of each row, and (shingle, times) of shingles that are frequent in some piece.

    An empty or null text has an empty set: set_id null and no sketches.
    """
    kind = next(t.dataType for t in docs.schema if t.name == key)
    names = ["kind", key, "set_id", "n_shingles", "sketch", "short_sketch"]
    schema = f"kind int, {key} {kind.simpleString()}, set_id bigint, n_shingles bigint, sketch binary, short_sketch binary"

    def batches(them):
        for batch in them:
            for piece in slices(batch, text, REPORT_BYTES):
                sets, ids = _sets(piece, text, like.width)
                sizes = [len(s) for s in sets]
                seen, at = np.unique(ids, return_index=True)
                values, times = np.unique(np.concatenate([sets[i] for i in at]), return_counts=True)
                often = times >= REPORTED
                sketches = [_sketch(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.zeros(len(sets), np.int32)), piece.column(key),
                        pa.array(ids.view(np.int64), mask=np.array(sizes) == 0), pa.array(sizes, pa.int64()),
                        pa.array(sketches, pa.binary()), pa.array([x and _short(x, n, like) for x, n in zip(sketches, sizes)], pa.binary()),
                    ], names=names,
                )
                k = int(often.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.ones(k, np.int32)), pa.nulls(k, piece.column(key).type), pa.array(values[often].view(np.int64)),
                        pa.array(times[often].astype(np.int64)), pa.nulls(k, pa.binary()), pa.nulls(k, pa.binary()),
                    ], names=names,
                )

    both = saved(docs.select(key, text).mapInArrow(batches, schema), "digests")
    rows = both.filter("kind = 0").drop("kind")
    return rows, both.filter("kind = 1").groupBy(F.col("set_id").alias("shingle")).agg(F.sum("n_shingles").alias("times"))


def _frequent(counted: DataFrame) -> np.ndarray:
    """The (at most FREQUENT) most frequent shingles in order."""
    top = counted.orderBy(F.desc("times"), "shingle").limit(FREQUENT).select("shingle").toPandas()["shingle"]
    return np.sort(top.to_numpy(np.int64).view(np.uint64))


def _entries(docs: DataFrame, text: str, like: Likeness, boundary: int, shared) -> DataFrame:
    """(token, kind, set_id, size, place): list entries (kind 0) and enumerated subsets.

    Kind 1: two sets of one size; 2 and 3: the smaller and the larger set of a size pair. `place` is an entry's place in its set's order.
    """

    def batches(them):
        frequent = shared.value
        perhaps = np.zeros(1 << 22, bool)
        perhaps[frequent >> np.uint64(42)] = True
        for batch in them:
            for piece in slices(batch, text):
                sets, ids = _sets(piece, text, like.width)
                out = [[], [], [], [], []]

                def add(tokens, kind, set_ids, size, places):
                    for column, value in zip(out, (tokens, kind, set_ids, size, places)):
                        column.append(value if isinstance(value, np.ndarray) else np.full(len(tokens), value, np.int64))

                small: dict[int, list[int]] = {}
                for i in np.unique(ids, return_index=True)[1].tolist():
                    s, n = sets[i], len(sets[i])
                    if n and n <= like.den * boundary // like.num:
                        small.setdefault(n, []).append(i)
                    if n > boundary:
                        p = like.prefix(n)
                        late = perhaps[s >> np.uint64(42)]
                        if late.any():
                            late[late] = frequent[np.minimum(np.searchsorted(frequent, s[late]), len(frequent) - 1)] == s[late]
                            s = np.concatenate([s[~late], s[late]])
                        add(s[:p], 0, int(ids[i : i + 1].view(np.int64)[0]), n, np.arange(p))
                for n, rows in small.items():
                    mixed = mix(np.stack([sets[i] for i in rows]))
                    whole, own = mixed.sum(axis=1), ids[rows].view(np.int64)
                    for lo, hi, c in _tags(like, n, boundary):
                        away = _left_out(n, c)
                        sums = whole[:, None] - (mixed[:, away].sum(axis=2) if n > c else np.zeros((len(rows), 1), np.uint64))
                        tokens = mix(sums + np.uint64(lo * 4096 + hi)).ravel()
                        add(tokens, 1 if lo == hi else 2 if n == lo else 3, np.repeat(own, sums.shape[1]), n, 0)
                if out[0]:
                    columns = [np.concatenate(c) for c in out]
                    for lo in range(0, len(columns[0]), 200_000):
                        token, kind, own, size, place = (c[lo : lo + 200_000] for c in columns)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(token.view(np.int64)), pa.array(kind.astype(np.int32)), pa.array(own), pa.array(size.astype(np.int32)), pa.array(place.astype(np.int32))],
                            names=["token", "kind", "set_id", "size", "place"],
                        )

    return docs.select(text).mapInArrow(batches, "token bigint, kind int, set_id bigint, size int, place int")


def _fits(like: Likeness) -> str:
    """Whether two entries of a list can be the first that linked sets share."""
    return f"least(a.size - a.place, b.size - b.place) * {like.num + like.den} >= (a.size + b.size) * {like.num}"


def _near_sketches(pairs: DataFrame, sketches: DataFrame, like: Likeness) -> DataFrame:
    """The pairs (a, b) whose sketches don't rule a link out."""
    x = sketches.select(F.col("set_id").alias("a"), F.col("n_shingles").alias("n"), F.col("sketch").alias("x"))
    y = sketches.select(F.col("set_id").alias("b"), F.col("n_shingles").alias("m"), F.col("sketch").alias("y"))
    both = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b")

    def batches(them: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in them:
            keep = []
            for n, m, x, y in zip(rows["n"], rows["m"], rows["x"], rows["y"]):
                size = min(len(x), len(y))
                apart = int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())
                keep.append(apart <= n + m - 2 * like.overlap(n, m))
            yield rows.loc[keep, ["a", "b"]]

    return both.mapInPandas(batches, "a bigint, b bigint")


def _verified(docs: DataFrame, text: str, pairs: DataFrame, like: Likeness) -> DataFrame:
    """Those of the pairs (a, b) of set ids that link, by their shingles."""
    pairs = saved(pairs, "candidates")
    wanted = pairs.select(F.col("a").alias("set_id")).unionAll(pairs.select(F.col("b").alias("set_id"))).distinct()

    def batches(them):
        for batch in them:
            for piece in slices(batch, text):
                sets, ids = _sets(piece, text, like.width)
                at = [i for i in np.unique(ids, return_index=True)[1].tolist() if len(sets[i])]
                if at:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[at].view(np.int64)), pa.array([sets[i].view(np.int64) for i in at], pa.list_(pa.int64()))],
                        names=["set_id", "shingles"],
                    )

    few = wanted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    every = docs.select(text).mapInArrow(batches, "set_id bigint, shingles array<bigint>")
    sets = every.join(F.broadcast(wanted) if few else wanted, "set_id", "left_semi").dropDuplicates(["set_id"])
    sets = saved(sets, "sets")
    x, y = (sets.select(F.col("set_id").alias(k), F.col("shingles").alias(s)) for k, s in (("a", "x"), ("b", "y")))
    common = F.size(F.array_intersect("x", "y"))
    linked = pairs.join(x.hint("merge"), "a").join(y.hint("merge"), "b").withColumn("common", common)
    out = saved(linked.filter(F.col("common") * (like.den + like.num) >= (F.size("x") + F.size("y")) * like.num).select("a", "b"), "verified")
    forget(pairs, sets)
    return out


def _band(size: str) -> str:
    """The band of a size, four to each power of two."""
    return f"(4 * length(bin({size})) + cast(shiftright(8L * ({size}), length(bin({size}))) & 3 as int))"


def _across(lists: DataFrame, sketches: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b) of different components in heavy lists that short sketches, sizes and places allow.

    Lists of more than a block are cut into bands of sizes. A set is at home in the band of its size if it can be the smaller one of a
    pair by its place, and visits the bands of all sets that can be the smaller one beside it. So a pair meets in the band of its
    smaller set. Bands are compared block by block.
    """
    total, keys = like.num + like.den, ["token", "band", "i", "j"]
    zero = F.lit(0)
    whole = lists.filter(F.col("rows") <= BLOCK).drop("rows").withColumns({"band": zero, "home": F.lit(True), "block": zero, "i": zero, "j": zero})
    least, most = f"({like.num}L * size + {like.den - 1}) div {like.den}", f"least(size, (size - place) * {total}L div {like.num} - size)"
    rows = lists.filter(F.col("rows") > BLOCK).drop("rows").filter(F.expr(f"{most} >= {least}"))
    rows = rows.withColumn("band", F.explode(F.expr(f"sequence({_band(least)}, {_band(most)})")))
    rows = rows.withColumn("home", F.expr(f"band = {_band('size')} and (size - place) * {total}L >= 2L * size * {like.num}"))
    bands = rows.groupBy("token", "band").agg(
        F.count(F.lit(1)).alias("rows"), F.max("home").alias("homes"), F.min("component").alias("lo"), F.max("component").alias("hi")
    )
    bands = bands.filter("homes and lo < hi").select("token", "band", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(bands, ["token", "band"]).withColumn("block", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    # a block meets each block of its band once: (i, j) with i <= j
    rows = rows.withColumn("other", F.explode(F.sequence(zero, F.col("blocks") - 1)))
    rows = rows.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("blocks", "other")
    pairs = whole.unionByName(rows).join(sketches.select("set_id", "short_sketch"), "set_id")

    def found(rows: pa.RecordBatch, first: np.ndarray) -> pa.RecordBatch:
        """The near pairs of whole groups that lie one behind the other from the places `first` on."""
        ids, group, block, size, place, home, i, j = (
            rows.column(c).to_numpy(zero_copy_only=False) for c in ("set_id", "component", "block", "size", "place", "home", "i", "j")
        )
        size, alone = size.astype(np.int64), i == j
        rest = size - place
        ends = np.repeat(np.append(first[1:], rows.num_rows), np.diff(first, append=rows.num_rows))
        texts = rows.column("short_sketch").to_pylist()
        lengths = np.array([len(x) for x in texts])
        at, packed = np.zeros(rows.num_rows, np.int64), {}
        for length in np.unique(lengths).tolist():
            those = np.flatnonzero(lengths == length)
            at[those] = np.arange(len(those))
            packed[length] = np.frombuffer(b"".join(texts[k] for k in those), np.uint8).reshape(-1, length)

        def near(p: np.ndarray, q: np.ndarray) -> np.ndarray:
            """Which of the pairs have sketches that allow a link; sketches of two lengths meet at the shorter."""
            both = size[p] + size[q]
            allowed = both + 2 * (-like.num * both // total)
            keep = np.zeros(len(p), bool)
            kinds = lengths[p] * (1 << 32) + lengths[q]
            for kind in np.unique(kinds).tolist():
                one, two = kind >> 32, kind & 0xFFFFFFFF
                length, those = min(one, two), np.flatnonzero(kinds == kind)
                step = max(1, UNPACKED // max(one, two))
                for lo in range(0, len(those), step):
                    some = those[lo : lo + step]
                    x, y = packed[one][at[p[some]]], packed[two][at[q[some]]]
                    x, y = (np.bitwise_xor.reduce(z.reshape(len(some), -1, length), axis=1) for z in (x, y))
                    keep[some] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64) <= allowed[some]
            return keep

        out, waiting, held, p, step = [], [], 0, np.arange(rows.num_rows), 0
        while len(p):
            step += 1
            p = p[p + step < ends[p]]
            q = p + step
            need = -(-like.num * (size[p] + size[q]) // total)
            fits = (np.minimum(rest[p], rest[q]) >= need) & (group[p] != group[q]) & (home[p] | home[q]) & (alone[p] | (block[p] != block[q]))
            waiting.append((p[fits], q[fits]))
            held += len(waiting[-1][0])
            if held >= GATHERED or not len(p):
                a, b = (np.concatenate(side) for side in zip(*waiting))
                keep = near(a, b)
                out.append((a[keep], b[keep]))
                waiting, held = [], 0
        a, b = (ids[np.concatenate(side)] for side in zip(*out))
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

    def batches(them: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in them:
            if batch.num_rows == 0:
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            values = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in keys])
            first = np.append(0, np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1)
            # the last group may go on in the next batch
            if len(first) > 1:
                yield found(rows.slice(0, int(first[-1])), first[:-1])
            held = rows.slice(int(first[-1]))
        if held is not None:
            yield found(held, np.zeros(1, np.int64))

    return pairs.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(batches, "a bigint, b bigint")


def set_links(docs: DataFrame, text: str, like: Likeness, rows: DataFrame, frequent: DataFrame) -> DataFrame:
    """(a, b): links between different sets, enough of them to connect whatever is connected."""
    spark = docs.sparkSession
    sizes = rows.filter(F.col("n_shingles").between(1, 2 * SMALLEST_LARGE)).groupBy("n_shingles").count().collect()
    boundary = best_boundary(like, {r[0]: r[1] for r in sizes})
    entries = _entries(docs, text, like, boundary, share(spark, _frequent(frequent)))
    by_set = rows.filter("set_id is not null").groupBy("set_id")
    sketches = by_set.agg(F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"))
    short = by_set.agg(F.first("short_sketch").alias("short_sketch"))

    # lists with at least two sets; copies of a set count once (sides that grow with the corpus are never broadcast)
    lists = entries.groupBy("token", "kind").agg(F.min("set_id").alias("lo"), F.max("set_id").alias("hi"))
    several = lists.filter("kind > 1 or lo < hi").select("token", "kind")
    members = saved(entries.join(several.hint("merge"), ["token", "kind"]).dropDuplicates(["token", "kind", "set_id"]), "lists")

    subsets = members.filter("kind > 0")
    hubs = subsets.groupBy("token").agg(
        F.min(F.when(F.col("kind") == 1, F.col("set_id"))).alias("one"),
        F.min(F.when(F.col("kind") == 2, F.col("set_id"))).alias("small"),
        F.min(F.when(F.col("kind") == 3, F.col("set_id"))).alias("large"),
    )
    hub = F.when(F.col("kind") == 1, F.col("one")).when(F.col("kind") == 2, F.col("large")).otherwise(F.col("small"))
    sure = subsets.join(hubs, "token").select(F.col("set_id").alias("a"), hub.alias("b")).filter("b is not null and a <> b").distinct()

    large = members.filter("kind = 0").drop("kind")
    heads = large.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min(F.struct("place", "set_id", "size")).alias("hub"))
    scanned = large.alias("a").join(
        heads.select("token", F.col("hub.place").alias("place"), F.col("hub.set_id").alias("set_id"), F.col("hub.size").alias("size")).alias("b").hint("merge"),
        "token",
    ).filter("a.set_id <> b.set_id").filter(_fits(like))
    ordered = [F.least("a.set_id", "b.set_id").alias("a"), F.greatest("a.set_id", "b.set_id").alias("b")]
    first = _verified(docs, text, _near_sketches(scanned.select(*ordered).distinct(), sketches, like), like)
    links = saved(first.unionAll(sure), "links")

    # what the scans left apart: lists whose sets lie in several components
    found = components(links)
    grouped = large.join(found.withColumnRenamed("id", "set_id"), "set_id", "left").withColumn("component", F.coalesce("component", "set_id"))
    apart = grouped.groupBy("token").agg(F.count(F.lit(1)).alias("rows"), F.min("component").alias("lo"), F.max("component").alias("hi"))
    rest = saved(grouped.join(apart.filter("lo < hi and rows > 2").select("token", "rows"), "token"), "rest")
    forget(members)
    light = rest.filter(F.col("rows") <= LIGHT)
    near = light.alias("a").join(light.alias("b"), "token").filter("a.component < b.component").filter(_fits(like)).select(*ordered)
    more = near.unionAll(_across(rest.filter(F.col("rows") > LIGHT), short, like)).distinct()
    second = _verified(docs, text, _near_sketches(more, sketches, like), like)
    forget(rest)
    return links.unionAll(second)


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness = Likeness()) -> DataFrame:
    """`key`, n_shingles, component_id and set_component for each row of `docs`.

    component_id is the smallest key of all documents that can be reached over links (the row's own without any); rows of equal
    sets are one node. Null and empty texts, and texts without words, have no shingles and link with nothing: component_id is
    their own key. A null key is never the smallest unless no other is there. set_component numbers the component by set (null
    without shingles). Repeated rows each come out; an empty table gives an empty one.
    """
    docs = docs.select(F.col(f"`{key}`"), F.col(f"`{text}`"))
    rows, frequent = digests(docs, key, text, like)
    links = set_links(docs, text, like, rows, frequent)
    nodes = components(links).withColumnsRenamed({"id": "set_id", "component": "set_component"})
    # rows of one set become one row before components are put to them, so a hot set is no hot key later
    sets = rows.filter("set_id is not null").groupBy("set_id").agg(F.min(key).alias("least"))
    placed = sets.join(nodes, "set_id", "left").withColumn("set_component", F.coalesce("set_component", "set_id"))
    placed = saved(placed, "components")
    named = placed.groupBy("set_component").agg(F.min("least").alias("component_id"))
    every = placed.join(named, "set_component").select("set_id", "set_component", "component_id")
    out = rows.drop("sketch", "short_sketch").join(every, "set_id", "left")
    alone = F.when(F.col("set_id").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return out.select(key, "n_shingles", alone.alias("component_id"), "set_component", "set_id")


def documents_components(docs: DataFrame) -> DataFrame:
    found = similar_documents(docs.select("doc_id", "text"))
    return found.select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT r, array_to_string(w[i : i + 2], ' ') AS s
  FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM words WHERE len(w) > 0)
), sized AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
pairs AS (
  SELECT a.r AS x, b.r AS y, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.r < b.r GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs JOIN sized p ON p.r = x JOIN sized q ON q.r = y WHERE 100 * common >= 90 * (p.n + q.n - common)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(r, t) AS (SELECT r, r FROM sized UNION SELECT reach.r, y FROM reach JOIN both_ways ON x = t),
least AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN words ON words.r = t GROUP BY 1)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id
FROM words LEFT JOIN sized USING (r) LEFT JOIN least USING (r)
"""


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", like: Likeness = Likeness()) -> DataFrame:
    """`docs` with one document of each component: that of the smallest key (a null key only if there is no other).

    Documents without words are in no component and all stay. Of rows that repeat a key and a set of shingles one stays.
    """
    found = similar_documents(docs, key, text, like).filter("set_id is not null")
    best = found.groupBy("set_component").agg(F.min(F.struct(F.col(key).isNull(), F.col(key).alias("key"), F.col("set_id").alias("own"))).alias("best"))
    own, wanted, its = (fresh(c, docs.columns) for c in ("set_id", "wanted_key", "wanted_set"))
    best = best.select(F.col("best.key").alias(wanted), F.col("best.own").alias(its))
    names = [*docs.columns, own]

    def batches(them):
        for batch in them:
            for piece in slices(batch, text):
                sets, ids = _sets(piece, text, like.width)
                mine = pa.array(ids.view(np.int64), mask=np.array([len(s) == 0 for s in sets]))
                yield pa.RecordBatch.from_arrays([*piece.columns, mine], names=names)

    marked = docs.mapInArrow(batches, T.StructType([*docs.schema.fields, T.StructField(own, T.LongType())]))
    same = F.col(f"`{key}`").eqNullSafe(F.col(wanted)) & (F.col(own) == F.col(its))
    chosen = marked.filter(F.col(own).isNotNull()).join(best, same, "left_semi")
    wordless = ~F.coalesce(F.col(f"`{text}`").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return chosen.dropDuplicates([key, own]).drop(own).unionByName(docs.filter(wordless))
