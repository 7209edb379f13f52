"""Exact top-k inner products with a KD-tree per shard.

Method. Vectors are dealt by a hash into shards; each shard builds a KD-tree by median splits of the widest
side, with tight bounding boxes. A query visits boxes best first: the bound of a box is the largest inner
product that any point of the box could have, and the search of a tree ends when the best box left is
below the kth score so far. Each query first searches its home shard; the kth score found there is
propagated to all other shards as the bound to begin with. Ties are kept until the end.

Scale. Queries meet every shard once, in blocks: what is shuffled is shards times queries plus query blocks
times vectors. A task holds one shard of about ``SHARD_ROWS`` vectors and ``QUERY_ROWS`` queries at a time.
Equal vectors make boxes without extent, which are leaves of any size.

Cases. Null vectors, vectors with a null or non-finite component and rows without id take no part. Only
vectors of one length are compared. A query is not its own candidate, nor are rows with its id; other
repeated rows are candidates each. Repeated queries answer once. Scores must fit in 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homespan.llm.common import stored

SHARD_ROWS = 8192
QUERY_ROWS = 2048
QUERY_BLOCK = 100_000
LEAF = 128

FOUND_SQL = "query_id long, query_mark long, vec_id long, score long"
FOUND = pa.schema([(n, pa.int64()) for n in ("query_id", "query_mark", "vec_id", "score")])


class KdTree:
    def __init__(self, ids: np.ndarray, points: np.ndarray):
        """Points are sorted by id first, so rows of a leaf are in order of id."""
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.low, self.high, self.children, self.rows = [], [], [], []
        self._grow(np.arange(len(ids)))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, rows: np.ndarray) -> int:
        here = self.points[rows]
        low, high = here.min(axis=0), here.max(axis=0)
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(None)
        side = int((high - low).argmax()) if len(low) else 0
        if len(rows) <= LEAF or not len(low) or high[side] == low[side]:
            self.rows[node] = rows
            return node
        values = here[:, side]
        middle = np.median(values)
        left = values < middle if (values < middle).any() else values <= middle
        self.children[node] = (self._grow(rows[left]), self._grow(rows[~left]))
        return node

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, least: np.ndarray) -> Iterator[tuple]:
        """(query position, ids, scores) of the best k that reach ``least``, best first."""
        bounds = np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T
        for at, query in enumerate(queries):
            ids, scores = np.zeros(0, np.int64), np.zeros(0, queries.dtype)
            kth, row = least[at], bounds[at]
            heap = [(-row[0], 0)]
            while heap:
                bound, node = heappop(heap)
                if -bound < kth:
                    break
                if self.children[node]:
                    for child in self.children[node]:
                        if row[child] >= kth:
                            heappush(heap, (-row[child], child))
                    continue
                rows = self.rows[node]
                got = self.points[rows] @ query
                good = (got >= kth) & (self.ids[rows] != query_ids[at])
                if good.any():
                    ids, scores = np.append(ids, self.ids[rows][good]), np.append(scores, got[good])
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                    if len(scores) == k:
                        kth = max(kth, scores[-1])
            yield at, ids, scores


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _exact(points: list[np.ndarray]) -> np.ndarray:
    """Integers as doubles where all sums stay exact, else as 64-bit integers."""
    points = np.concatenate(points)
    largest = np.abs(points).max(initial=0).astype(float)
    return points.astype(np.float64) if largest * largest * max(1, points.shape[1]) < 2**52 else points


def _searched(batches: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (size, shard, block, kind): the vectors of a shard, then its queries."""
    key, tree, ids, points = None, None, [], []
    for batch in batches:
        marks = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
        edges = np.concatenate([[0], np.flatnonzero((marks[1:] != marks[:-1]).any(axis=1)) + 1, [len(marks)]])
        for begin, end in zip(edges[:-1], edges[1:], strict=True):
            if end == begin:
                continue
            group, kind = tuple(marks[begin, :3]), marks[begin, 3]
            if group != key:
                key, tree, ids, points = group, None, [], []
            part = batch.slice(begin, end - begin)
            own, vectors = part.column("id").to_numpy(zero_copy_only=False), _matrix(part.column("vector"))
            if kind == 0:
                ids.append(own)
                points.append(vectors)
                continue
            if not points and tree is None:
                continue
            if tree is None:
                tree, points = KdTree(np.concatenate(ids), _exact(points)), []
            least, mark = part.column("least").to_numpy(zero_copy_only=False), part.column("mark").to_numpy(zero_copy_only=False)
            for b in range(0, len(own), QUERY_ROWS):
                rows = slice(b, b + QUERY_ROWS)
                queries = vectors[rows]
                if np.abs(queries).max(initial=0) >= 2**20 or tree.points.dtype != np.float64:
                    tree.points, tree.low, tree.high = (a.astype(np.int64) for a in (tree.points, tree.low, tree.high))
                queries = queries.astype(tree.points.dtype)
                found = list(tree.search(own[rows], queries, k, least[rows]))
                sizes = [len(i) for _, i, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(own[rows], sizes)),
                        pa.array(np.repeat(mark[rows], sizes)),
                        pa.array(np.concatenate([i for _, i, _ in found])),
                        pa.array(np.concatenate([s for _, _, s in found]).astype(np.int64)),
                    ],
                    schema=FOUND,
                )


def whole_numbers(column: str, scale: int = 256) -> Column:
    """floor(scale * x) of every component, or null when the vector takes no part."""
    x = F.col(column)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(fine, F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k largest inner products of each query, ties to the smaller id.

    Both inputs have ``id`` (long) and ``vector`` (array of longs).
    """
    usable = "id is not null and vector is not null and size(vector) > 0"
    size = F.size("vector").alias("dim")
    data = stored(vectors.filter(usable).select("id", "vector", size))
    asked = queries.filter(usable).select("id", "vector", size, F.xxhash64("vector").alias("mark")).distinct()
    asked = stored(asked)
    shards = max(1, -(-data.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    shard = F.pmod(F.xxhash64("id"), F.lit(shards))
    block = F.pmod(F.xxhash64("id", "mark"), F.lit(blocks))
    each_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    placed = data.select("dim", shard.alias("shard"), each_block.alias("block"), F.lit(0).alias("kind"), "id", "vector")
    placed = placed.withColumns({"mark": F.lit(0).cast("long"), "least": F.lit(float("-inf"))})

    def search(rows: DataFrame) -> DataFrame:
        both = placed.unionByName(rows)
        keys = ["dim", "shard", "block"]
        dealt = both.repartition(*keys).sortWithinPartitions(*keys, "kind")
        return dealt.mapInArrow(lambda b: _searched(b, k), FOUND_SQL)

    columns = ["dim", "shard", "block", F.lit(1).alias("kind"), "id", "vector", "mark", "least"]
    home = asked.withColumns({"shard": shard, "block": block, "least": F.lit(float("-inf"))}).select(*columns)
    at_home = stored(search(home))
    reached = at_home.groupBy("query_id", "query_mark").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
    least = F.when(F.col("n") == k, F.col("kth").cast("double")).otherwise(F.lit(float("-inf")))
    known = reached.select(F.col("query_id").alias("id"), F.col("query_mark").alias("mark"), least.alias("least"))
    away = asked.join(known, ["id", "mark"], "left").fillna({"least": float("-inf")}).withColumn("block", block)
    away = away.withColumn("home", shard)
    away = away.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    others = search(away.filter("shard <> home").select(*columns))
    best = Window.partitionBy("query_id", "query_mark").orderBy(F.desc("score"), "vec_id")
    ranked = at_home.unionByName(others).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
