"""Exact top-k search by inner product: a ball tree in each shard, searched by branch and bound.

The vectors are dealt into shards and the queries into blocks; a task holds one shard and one block. It builds a ball tree of its
shard, visits the nodes in the order of their upper bounds (query times centre plus norm times radius) and leaves out those that
cannot reach a query's current k-th score. That score is shared by all nodes of a task, and begins at the k-th score among a
bounded pilot set, which every block searches first.
"""

from __future__ import annotations

import sys
from operator import mul

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.common import saved, share

SHARD_ROWS = 16_384
BLOCK_QUERIES = 4_096
#: Vectors of the pilot set, at most.
PILOT = 2_048
LEAF = 128
#: Integer products whose norms multiply to less are exact in 64-bit floats; the others are made of whole Python numbers.
EXACT = float(1 << 52)


def _norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows**2).sum(axis=1))


def _below(score: int) -> float:
    """A float that is not greater than a whole number of any size."""
    try:
        return float(np.nextafter(float(score), -np.inf))
    except OverflowError:
        return sys.float_info.max if score > 0 else -np.inf


def _place(score: int) -> str:
    """A text that puts scores beyond 64 bits in order and around "5", which all the others have."""
    if -(1 << 63) <= score < 1 << 63:
        return "5"
    digits = str(abs(score))
    text = f"{len(digits):05d}{digits}"
    return f"9{text}" if score > 0 else "1" + text.translate(str.maketrans("0123456789", "9876543210"))


class BallTree:
    """Nodes of vectors split at the median along the widest direction; leaves hold at most LEAF vectors."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.order = np.lexsort((ids,))
        self.rows, self.ids = rows[self.order], ids[self.order]
        self.nodes: list[tuple[np.ndarray, float, int, int, int, int]] = []
        with np.errstate(over="ignore", invalid="ignore"):
            self.most = float(_norms(self.rows).max(initial=0.0))
            if len(ids):
                self._build(0, len(ids))

    def _build(self, lo: int, hi: int) -> int:
        rows = self.rows[lo:hi]
        centre = rows.mean(axis=0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        at = len(self.nodes)
        self.nodes.append((centre, radius, lo, hi, -1, -1))
        if hi - lo > LEAF and radius > 0:
            far = rows[np.argmax(((rows - centre) ** 2).sum(axis=1))]
            side = rows @ (far - centre)
            split = np.argsort(side, kind="stable")
            self.rows[lo:hi], self.ids[lo:hi] = rows[split], self.ids[lo:hi][split]
            mid = (lo + hi) // 2
            left, right = self._build(lo, mid), self._build(mid, hi)
            self.nodes[at] = (centre, radius, lo, hi, left, right)
        return at


class Search:
    """The best k of each query so far, by score and then the smaller id."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.queries, self.k = ids, queries, k
        with np.errstate(over="ignore"):
            self.norms = _norms(queries)
        #: queries whose products may be too large for floats, and their best (negative score, id) so far
        self.wide = np.zeros(len(ids), bool)
        self.best: dict[int, list[tuple[int, int]]] = {}
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        #: a score that k vectors are known to reach
        self.bar = floor.astype(np.float64)

    def visit(self, tree: BallTree) -> None:
        """Nodes by depth first, of two children the one with the higher bound first, for all queries that still need them."""
        if not tree.nodes:
            return
        with np.errstate(over="ignore", invalid="ignore"):
            self.wide = ~(self.norms * tree.most < EXACT)
            self._walk(tree)

    def _walk(self, tree: BallTree) -> None:
        stack = [(0, np.arange(len(self.ids)), self._bound(tree, 0, np.arange(len(self.ids))))]
        while stack:
            node, active, bound = stack.pop()
            active = active[~(bound < self.bar[active])]
            if not len(active):
                continue
            _, _, lo, hi, left, right = tree.nodes[node]
            if left < 0:
                wide = self.wide[active]
                if not wide.all():
                    self._leaf(active[~wide], tree.ids[lo:hi], tree.rows[lo:hi])
                if wide.any():
                    self._wide_leaf(active[wide], tree.ids[lo:hi], tree.rows[lo:hi])
                continue
            bounds = [(c, active, self._bound(tree, c, active)) for c in (left, right)]
            stack.extend(sorted(bounds, key=lambda b: b[2].max()))

    def _bound(self, tree: BallTree, node: int, active: np.ndarray) -> np.ndarray:
        centre, radius = tree.nodes[node][:2]
        top = self.queries[active] @ centre + self.norms[active] * radius
        return top + self._error(self.norms[active] * (np.sqrt((centre**2).sum()) + radius))

    def _error(self, norms: np.ndarray) -> np.ndarray:
        """More than rounding can change in a product of two vectors whose norms multiply to `norms`."""
        return (self.queries.shape[1] + 16) * 2.0**-49 * norms + 1e-6

    def _leaf(self, active: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        scores = self.queries[active] @ rows.T
        scores[self.ids[active][:, None] == ids[None, :]] = -np.inf
        some = np.flatnonzero((scores >= self.bar[active][:, None]).any(axis=1))
        if not len(some):
            return
        active, scores = active[some], scores[some]
        every = np.concatenate([self.scores[active], scores], axis=1)
        names = np.concatenate([self.found[active], np.broadcast_to(ids, scores.shape)], axis=1)
        best = np.lexsort((names, -every), axis=1)[:, : self.k]
        self.scores[active] = np.take_along_axis(every, best, axis=1)
        self.found[active] = np.take_along_axis(names, best, axis=1)
        self.bar[active] = np.maximum(self.bar[active], self.scores[active, -1])

    def _wide_leaf(self, active: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Floats leave out what cannot reach the bar; the scores of the rest are made of whole numbers."""
        near = self.queries[active] @ rows.T + self._error(self.norms[active][:, None] * _norms(rows)[None, :])
        may = ~(near < self.bar[active][:, None]) & (self.ids[active][:, None] != ids[None, :])
        whole = {j: [int(v) for v in rows[j]] for j in np.flatnonzero(may.any(axis=0)).tolist()}
        for i in np.flatnonzero(may.any(axis=1)).tolist():
            a = int(active[i])
            query = [int(v) for v in self.queries[a]]
            scored = [(-sum(map(mul, query, whole[j])), int(ids[j])) for j in np.flatnonzero(may[i]).tolist()]
            self.best[a] = sorted(self.best.get(a, []) + scored)[: self.k]
            if len(self.best[a]) == self.k:
                self.bar[a] = max(self.bar[a], _below(-self.best[a][-1][0]))

    def frame(self) -> pd.DataFrame:
        """query_id, vec_id, score (null beyond 64 bits) and the score's place (_place)."""
        row, at = np.nonzero(np.isfinite(self.scores))
        plain = pd.DataFrame({"query_id": self.ids[row], "vec_id": self.found[row, at], "score": self.scores[row, at].astype(np.int64), "place": "5"})
        wide = [(int(self.ids[a]), i, -s, _place(-s)) for a, best in self.best.items() for s, i in best]
        if not wide:
            return plain.astype({"score": "Int64"})
        more = pd.DataFrame({
            "query_id": [w[0] for w in wide], "vec_id": [w[1] for w in wide],
            "score": pd.array([w[2] if w[3] == "5" else None for w in wide], "Int64"), "place": [w[3] for w in wide],
        })
        return pd.concat([plain.astype({"score": "Int64"}), more], ignore_index=True)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def scaled(vectors: DataFrame, key: str, vector: str, scale: int, k: int) -> DataFrame:
    """(vec_id, x, dims): floor(scale * component) of each row that takes part.

    Vectors that are null or empty, hold a null or non-finite component (once scaled, as in the SQL), or have no id, take no part.
    Every row counts, those of an id that repeats too; of equal rows k are kept, as no more can be among k places.
    """
    raw = F.transform(F.col(f"`{vector}`"), lambda v: F.lit(float(scale)) * v.cast("double"))
    usable = F.forall("raw", lambda v: v.isNotNull() & (F.abs(v) < float("inf"))) & (F.size("raw") > 0)
    # from 2^52 on a float has no fraction, and floor() would not fit 64 bits
    x = F.transform("raw", lambda v: F.when(F.abs(v) < EXACT, F.floor(F.when(F.abs(v) < EXACT, v)).cast("double")).otherwise(v))
    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), raw.alias("raw"))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("raw").isNotNull() & usable).select("vec_id", x.alias("x"))
    copies = kept.groupBy("vec_id", "x").agg(F.least(F.count(F.lit(1)), F.lit(k)).alias("n"))
    return copies.select("vec_id", "x", F.size("x").alias("dims"), F.explode(F.sequence(F.lit(1).cast("bigint"), "n")).alias("copy")).drop("copy")


def top_k(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest integer inner products of each query with the other vectors.

    `queries` holds ids of `vectors`. Equal scores go to the smaller id. Every finite vector takes part; ranks are exact for scores of any
    size, and a score that does not fit 64 bits is null. All rows count, copies too: the rows of one query id share its k places (and are
    no candidates of each other), a candidate row that occurs twice takes two. A query meets vectors of its own number of
    dimensions. Fewer than k candidates give as many rows. No table is broadcast but the pilot set (PILOT rows at most).
    """
    spark = vectors.sparkSession
    table = saved(scaled(vectors, key, vector, scale, k), "vectors")
    asked = table.join(queries.select(F.col(f"`{key}`").cast("bigint").alias("vec_id")).distinct(), "vec_id", "left_semi")
    rows, n = table.count(), asked.count()
    shards, blocks = max(1, -(-rows // SHARD_ROWS)), max(1, -(-n // BLOCK_QUERIES))
    pilot = table.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PILOT).collect()
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dims in {r["dims"] for r in pilot}:
        own = [r for r in pilot if r["dims"] == dims]
        known[dims] = (np.array([r["vec_id"] for r in own]), np.array([r["x"] for r in own], np.float64))
    shared = share(spark, known)

    def first_bars(batches):
        for batch in batches:
            for dims, some in batch.groupby("dims"):
                ids, bar = some["vec_id"].to_numpy(), np.full(len(some), -np.inf)
                if dims in shared.value:
                    search = Search(ids, _matrix(some["x"]), k, bar)
                    search.visit(BallTree(*shared.value[dims]))
                    bar = search.bar
                yield pd.DataFrame({"vec_id": ids, "x": list(some["x"]), "dims": dims, "bar": bar})

    began = asked.mapInPandas(first_bars, "vec_id bigint, x array<double>, dims int, bar double")
    began = began.withColumn("block", F.pmod(F.xxhash64("vec_id", "x"), F.lit(blocks)).cast("int"))
    dealt = table.withColumn("shard", F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int"))
    left = began.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    right = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or shard.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64").assign(place="")
        queries = queries.sort_values("vec_id")
        found = Search(queries["vec_id"].to_numpy(), _matrix(queries["x"]), k, queries["bar"].to_numpy())
        found.visit(BallTree(shard["vec_id"].to_numpy(), _matrix(shard["x"])))
        return found.frame()

    by = ["dims", "block", "shard"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(search, "query_id bigint, vec_id bigint, score bigint, place string")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("place"), F.desc("score"), "vec_id"))
    return near.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def embeddings_top(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    return top_k(embeddings, embeddings.filter(F.col("vec_id") % every == 0), k)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(embedding) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 20 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored) WHERE rank <= 20
"""
