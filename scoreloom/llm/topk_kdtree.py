"""Exact top-k by inner product with one KD-tree per shard.

Rows are dealt into shards of bounded size, each with a KD-tree of median splits and tight bounding
boxes. A query walks a tree best first: the highest inner product a box allows is known from its
corners, and a box below the kth score found so far is left out. Queries first meet one shard;
the kth score they reach there goes with them to all other shards.

Components are ``floor(scale * x)`` and scores are exact integers. Defined results: vectors that are
null or hold null or non-finite components take no part; shorter vectors count as zero beyond
their end; a row is no candidate of its own, though an equal row is; ties go to the smaller id; an
empty table gives no rows; other columns are ignored. Scores beyond 64 bits end at its limits.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared_store import Workspace, ship_package
from .registry import query, read

SHARD_ROWS = 8192
QUERY_ROWS = 4096  # queries that one task holds at a time
LEAF_ROWS = 128
SAFE = 2.0**53  # below it, sums of products of whole numbers are exact in doubles
LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec")).where(
        F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", finite))


def as_matrix(vectors: pd.Series, scale: float) -> np.ndarray:
    """Whole components; Python integers where doubles could not add them exactly."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = np.floor(scale * np.asarray(v, np.float64))
    return out


def exact(matrix: np.ndarray) -> np.ndarray:
    return np.array([[int(x) for x in row] for row in matrix], object).reshape(matrix.shape)


class Tree:
    """KD-tree over the rows of a matrix; node i has children 2i + 1 and 2i + 2."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        depth = max(0, int(np.ceil(np.log2(max(1, len(points)) / LEAF_ROWS))))
        self.inner = 2**depth - 1
        order = np.arange(len(points))
        self.span = [(0, len(points))]
        for node in range(self.inner):
            a, b = self.span[node]
            middle = (a + b) // 2
            part = points[order[a:b]]
            if b - a > 1 and points.shape[1]:
                axis = int(np.argmax(part.max(0) - part.min(0)))
                order[a:b] = order[a:b][np.argpartition(part[:, axis], middle - a)]
            self.span += [(a, middle), (middle, b)]
        self.points, self.ids, self.rows = points[order], ids[order], rows[order]
        boxes = [(self.points[a:b].min(0), self.points[a:b].max(0), self.ids[a:b].min()) if b > a else None for a, b in self.span]
        self.empty = np.array([x is None for x in boxes])
        zero = np.zeros(points.shape[1])
        self.low = np.array([zero if x is None else x[0] for x in boxes])
        self.high = np.array([zero if x is None else x[1] for x in boxes])
        self.first = np.array([LONG_MAX if x is None else x[2] for x in boxes], np.int64)

    def search(self, queries: np.ndarray, own_rows: np.ndarray, k: int, known: list[tuple[int, int] | None]) -> list[list[tuple[int, int]]]:
        """Per query the best (score, id) of this tree, best first; those behind ``known`` are left out."""
        width = max(queries.shape[1], self.points.shape[1])
        q, p, low, high = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, self.points, self.low, self.high))
        largest = max(np.abs(q).max(initial=0), np.abs(p).max(initial=0))
        if largest * largest * max(1, width) >= SAFE:
            q, p, low, high = map(exact, (q, p, low, high))
        bounds = np.maximum(q, 0) @ high.T + np.minimum(q, 0) @ low.T
        return [self._one(q[i], p, bounds[i], own_rows[i], k, known[i]) for i in range(len(q))]

    def _one(self, q: np.ndarray, p: np.ndarray, bound: np.ndarray, own: int, k: int, known: tuple[int, int] | None) -> list[tuple[int, int]]:
        best: list[tuple[int, int]] = []
        kth = known  # (score, id) that a new row has to beat
        heap = [(-bound[0], 0)]
        while heap:
            negative, node = heapq.heappop(heap)
            if self.empty[node]:
                continue
            if kth is not None and -negative < kth[0]:
                break
            if kth is not None and -negative == kth[0] and self.first[node] > kth[1]:
                continue
            if node < self.inner:
                for child in (2 * node + 1, 2 * node + 2):
                    heapq.heappush(heap, (-bound[child], child))
                continue
            a, b = self.span[node]
            scores = p[a:b] @ q
            keep = np.flatnonzero(scores >= kth[0]) if kth is not None else np.arange(b - a)
            found = [(int(scores[i]), int(self.ids[a + i])) for i in keep if self.rows[a + i] != own]
            if found:
                best = sorted(best + found, key=lambda x: (-x[0], x[1]))[:k]
                if len(best) == k and (kth is None or (-best[-1][0], best[-1][1]) < (-kth[0], kth[1])):
                    kth = best[-1]
        return best


def searcher(k: int, scale: float) -> Callable:
    schema_columns = ["row", "query_id", "score", "vec_id"]

    def run(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(asked):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in schema_columns})
        tree = Tree(as_matrix(shard["vec"], scale), shard["vec_id"].to_numpy(), shard["row"].to_numpy())
        known = [None if pd.isna(s) else (int(s), int(i)) for s, i in zip(asked["kth_score"], asked["kth_id"], strict=True)]
        found = tree.search(as_matrix(asked["vec"], scale), asked["row"].to_numpy(), k, known)
        flat = [(r, q, min(max(s, LONG_MIN), LONG_MAX), i)
                for r, q, hits in zip(asked["row"], asked["vec_id"], found, strict=True) for s, i in hits]
        return pd.DataFrame(flat, columns=schema_columns).astype(np.int64)

    return run


def top_k(
    vectors: DataFrame, is_query, work: Workspace, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vec_col: str = "embedding",
    shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` best rows for every row for which ``is_query`` holds: query_id, rank, vec_id, score.

    Tasks are pairs of a shard and a block of queries, both of bounded size.
    """
    ship_package(vectors.sparkSession)
    rows = work.save(usable(vectors, id_col, vec_col).withColumn("row", F.monotonically_increasing_id()), "vectors")
    total, asked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(is_query.cast("int")), F.lit(0))).first()
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-asked // query_rows))
    spread = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    points = rows.withColumn("shard", spread(shards))
    queries = rows.where(is_query).withColumn("block", spread(blocks)).withColumn("home", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(shards)).cast("int"))
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    shards_by_block = points.select("shard", "vec_id", "vec", "row", each_block)

    def meet(asked: DataFrame) -> DataFrame:
        run = searcher(k, scale)
        asked = asked.toDF(*asked.columns)  # columns of its own: both sides come from one table
        return shards_by_block.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
            run, "row long, query_id long, score long, vec_id long")

    best_first = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    null = F.lit(None).cast("long")
    at_home = work.save(meet(queries.withColumn("shard", F.col("home")).withColumns({"kth_score": null, "kth_id": null})), "home")
    kth = at_home.withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") == k).select(
        "row", F.col("score").alias("kth_score"), F.col("vec_id").alias("kth_id"))
    others = F.explode(F.array_except(F.sequence(F.lit(0), F.lit(shards - 1)), F.array("home"))).alias("shard")
    away = meet(queries.join(kth, "row", "left").select("row", "vec_id", "vec", "block", "kth_score", "kth_id", others))
    ranked = at_home.unionByName(away).withColumn("rank", F.row_number().over(best_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


# Components of checked tables are far below 2^20, so that sums of 64-bit products are exact here too.
TOP_K_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), s as (
  select a.vec_id as query_id, b.vec_id, cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id
  where a.vec_id % 50 = 0
)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
where rank <= 5
"""


@query("op4_topk_search", TOP_K_SQL)
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 50 == 0, Workspace(spark, "topk"))
