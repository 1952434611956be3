"""Exact top-k search by inner product: tiled matrix products, partial selection in every tile, tree merging.

Components become floor(scale * x). Queries are taken in blocks of a bounded number of distinct rows, one pass over the
candidates for each block, so what is broadcast doesn't grow with the data. A task multiplies the block with its rows
tile by tile and keeps the k best of each query: a tile's rows only count if they reach the k-th best so far, and where
many do, a partial selection finds the k-th best of the tile. The lists that tasks give for a query are merged in a
tree, FAN at a time, so no task ever holds more than FAN lists of a query.

Products are exact: in double precision where no sum can reach 2^53, in 64-bit integers below 2^63, else in integers of
any size, whose results beyond 2^63 - 1 in size count as that. Vectors that are null or hold null or not finite components
take no part; vectors of different lengths have no product; vectors without components have the product 0. A row isn't a
candidate for queries of its own id. Rows that repeat are candidates each; equal query rows are asked once, and
different vectors of one query id share one list of results. A null id is no query, and as a candidate comes last among
equal scores. Extra columns are left out; fewer than k candidates give fewer results, an empty table none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfmark.llm.common import batches, discard, stored
from shelfmark.llm.vectors import EXACT, whole

#: Queries in a block (and pass), queries and candidates in a tile, lists merged at a time.
QUERIES, TILE, FAN = 65_536, 1_024, 16
LAST, NONE = np.iinfo(np.int64).max, np.iinfo(np.int64).min
FOUND = "query_id long, shard int, best array<struct<neg:long,unknown:boolean,vec_id:long>>"


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a and b, exact and kept within a long."""
    n = a.shape[1]
    most = n * int(max(-int(a.min(initial=0)), int(a.max(initial=0)))) * int(max(-int(b.min(initial=0)), int(b.max(initial=0))))
    if most < EXACT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < LAST:
        return a @ b.T
    return np.clip(a.astype(object) @ b.astype(object).T, -LAST, LAST).astype(np.int64)


def tile_best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row and their places, by falling score and then place; places are in the order of ids."""
    n = scores.shape[1]
    if n > k:
        bar = np.partition(scores, n - k, axis=1)[:, n - k : n - k + 1]
        above, equal = scores > bar, scores == bar
        chosen = above | (equal & (equal.cumsum(axis=1) <= k - above.sum(axis=1, keepdims=True)))
        at = np.nonzero(chosen)[1].reshape(len(scores), k)
    else:
        at = np.broadcast_to(np.arange(n), scores.shape)
    found = np.take_along_axis(scores, at, axis=1)
    order = np.argsort(~found, axis=1, kind="stable")
    return np.take_along_axis(found, order, axis=1), np.take_along_axis(at, order, axis=1)


class Best:
    """The k best candidates so far of each query of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.scores = np.full((len(ids), k), NONE)
        self.found = np.full((len(ids), k), LAST)
        self.unknown = np.ones((len(ids), k), bool)

    def add(self, ids: np.ndarray, unknown: np.ndarray, vectors: np.ndarray) -> None:
        """Rows in the order of ids, null ids last."""
        for at in range(0, len(self.ids), TILE):
            q = slice(at, at + TILE)
            scores = products(self.vectors[q], vectors)
            scores[(self.ids[q, None] == ids) & ~unknown] = NONE
            rows = np.flatnonzero((scores >= self.scores[q, -1:]).any(axis=1))
            if not len(rows):
                continue
            top, place = tile_best(scores[rows], self.k)
            to = at + rows
            scores, found, unsure = np.hstack([self.scores[to], top]), np.hstack([self.found[to], ids[place]]), np.hstack([self.unknown[to], unknown[place]])
            order = np.lexsort((found, unsure, ~scores), axis=1)[:, : self.k]
            self.scores[to], self.found[to], self.unknown[to] = (np.take_along_axis(x, order, axis=1) for x in (scores, found, unsure))

    def lists(self, shard: int) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(self.ids), TILE):
            q = slice(at, at + TILE)
            there = self.scores[q] > NONE
            sizes = there.sum(axis=1)
            unsure = self.unknown[q][there]
            entry = pa.StructArray.from_arrays([pa.array(-self.scores[q][there]), pa.array(unsure), pa.array(self.found[q][there], mask=unsure)], names=["neg", "unknown", "vec_id"])
            some = np.flatnonzero(sizes)
            ends = pa.array(np.concatenate([[0], np.cumsum(sizes[some])]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[q][some]), pa.array(np.full(len(some), shard, np.int32)), pa.ListArray.from_arrays(ends, entry)], names=["query_id", "shard", "best"])


def in_order(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids as int64 and which are null."""
    unknown = ids.is_null().to_numpy(zero_copy_only=False)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), unknown


def searched(candidates: DataFrame, block: pa.Table, k: int, scale: int) -> DataFrame:
    """For every task and query of the block, the k best of the task's rows. candidates: id, vector."""
    ids, _ = in_order(block.column(0).combine_chunks())
    queries = {n: (ids[rows], vectors) for n, (rows, vectors) in whole(block.column(1), scale).items()}
    sent = candidates.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = {n: Best(i, v, k) for n, (i, v) in sent.value.items()}
        for batch in batches:
            ids, unknown = in_order(batch.column(0))
            for n, (rows, vectors) in whole(batch.column(1), scale).items():
                if n in best:
                    order = np.lexsort((ids[rows], unknown[rows]))
                    for at in range(0, len(rows), TILE):
                        o = order[at : at + TILE]
                        best[n].add(ids[rows[o]], unknown[rows[o]], vectors[o])
        for b in best.values():
            yield from b.lists(TaskContext.get().partitionId())

    return candidates.mapInArrow(run, FOUND)


def merged(lists: DataFrame, shards: int, k: int) -> DataFrame:
    """One list for each query: FAN lists are merged at a time."""
    while True:
        shards = -(-shards // FAN)
        best = F.slice(F.array_sort(F.flatten(F.collect_list("best"))), 1, k)
        lists = lists.groupBy("query_id", F.expr(f"cast(shard div {FAN} AS int)").alias("shard")).agg(best.alias("best"))
        if shards <= 1:
            return lists


def top_k(vectors: DataFrame, is_query: Column | str, k: int = 10, scale: int = 1024, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k rows with the largest inner product, for every row that is_query holds for."""
    spark = vectors.sparkSession
    batches(spark)
    rows = vectors.select(vectors[vec_id].cast("long").alias("vec_id"), vectors[vector].alias("vector"), (F.expr(is_query) if isinstance(is_query, str) else is_query).alias("asks"))
    # equal queries are asked once; a hash deals them over blocks
    queries = stored(rows.where("asks AND vec_id IS NOT NULL AND vector IS NOT NULL").select("vec_id", "vector").distinct().withColumn("hash", F.xxhash64("vec_id", "vector")), "queries")
    blocks = -(-queries.count() // QUERIES)
    candidates = rows.select("vec_id", "vector")
    shards = candidates.rdd.getNumPartitions()
    out = None
    for b in range(blocks):
        block = queries.where(F.pmod("hash", F.lit(blocks)) == b).select("vec_id", "vector").toArrow()
        lists = merged(searched(candidates, block, k, scale), shards, k)
        out = lists if out is None else out.unionByName(lists)
    discard(queries)
    if out is None:
        out = spark.createDataFrame([], FOUND)
    elif blocks > 1:  # an id with different vectors may be in several blocks
        out = merged(out.withColumn("shard", F.lit(0)), 1, k)
    return out.select("query_id", F.posexplode("best").alias("place", "b")).selectExpr("query_id", "place + 1 AS rank", "b.vec_id", "-b.neg AS score")


def op13_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every hundredth id, over all rows."""
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")


#: The same in SQL.
SEARCH_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS n FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.n, c.n), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.n) = len(c.n))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 10
"""
