"""Nearest neighbours by collision counting over single random projections.

Vectors are dealt into shards. A shard keeps, for each of m random directions, its vectors'
projections in a sorted array. A query opens a window around its own projection in every
array; the windows widen in rounds, by a factor (virtual rehashing: no array is built
anew), and each round counts only what it adds. A vector seen in at least `threshold` of
the m windows is verified by its true distance, at once and whole. A shard is done with a
query when its k-th best distance is within the round's radius: a vector that near lies in
each window with the probability of a normal variable within half the width, and reaches
the threshold almost surely. The best of all shards are merged by query.

Queries are dealt into blocks and meet every shard, block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from datamill.llm.tables import ship, written

DIRECTIONS = 48
# A window of this many radii holds a vector at the radius with probability 0.83.
WIDTH = 2.719
# Of 48 windows a vector at the radius is in 40, with a deviation of 2.6.
THRESHOLD = 31
WIDEN = 1.3
SHARD_ROWS = 16_384
QUERY_ROWS = 1024
FOUND = "query_id long, vec_id long, score double"


class ProjectionIndex:
    """Sorted arrays of the projections of one shard's vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, directions: int = DIRECTIONS) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        lines = np.random.default_rng(7).standard_normal((vectors.shape[1], directions))
        self.lines = lines
        values = self.vectors @ lines
        self.rows = np.argsort(values, axis=0, kind="stable").T.astype(np.int32).copy()
        self.values = np.sort(values, axis=0).T.copy()

    def search(self, own: int, query: np.ndarray, k: int, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, own id left out, nearest first."""
        n, m = len(self.ids), len(self.values)
        at = query @ self.lines
        count = np.zeros(n, np.int16)
        fresh = self.ids != own
        middle = np.array([np.searchsorted(self.values[j], at[j]) for j in range(m)])
        low, high = middle.copy(), middle.copy()
        # The first windows hold about 4 k vectors each.
        step = min(n, 4 * k)
        edge = [max(abs(self.values[j][max(0, middle[j] - step // 2)] - at[j]), abs(self.values[j][min(n - 1, middle[j] + step // 2)] - at[j])) for j in range(m)]
        radius = max(float(np.median(edge)) * 2 / WIDTH, 1e-9)
        found, distance = np.empty(0, np.int64), np.empty(0)
        while True:
            half = WIDTH * radius / 2
            added = []
            for j in range(m):
                a = int(np.searchsorted(self.values[j], at[j] - half, side="left"))
                b = int(np.searchsorted(self.values[j], at[j] + half, side="right"))
                a, b = min(a, low[j]), max(b, high[j])
                added += [self.rows[j][a : low[j]], self.rows[j][high[j] : b]]
                low[j], high[j] = a, b
            count += np.bincount(np.concatenate(added), minlength=n).astype(np.int16)
            reached = np.flatnonzero(fresh & (count >= threshold))
            if len(reached):
                fresh[reached] = False
                gap = self.vectors[reached] - query
                found = np.append(found, reached)
                distance = np.append(distance, np.sqrt((gap * gap).sum(axis=1)))
                best = np.lexsort((self.ids[found], distance))[:k]
                found, distance = found[best], distance[best]
            if (len(found) >= k and distance[k - 1] <= radius) or bool((low == 0).all() and (high == n).all()):
                return self.ids[found], distance
            radius *= WIDEN


def _search(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(vectors) or not len(queries):
            return schema.empty_table()
        index = ProjectionIndex(vectors["vec_id"].to_numpy(), _matrix(vectors["embedding"]))
        heads, tails, scores = [], [], []
        for own, query in zip(queries["q_vec_id"].to_pylist(), _matrix(queries["q_embedding"])):
            ids, distance = index.search(own, query, k)
            heads.append(np.full(len(ids), own))
            tails.append(ids)
            scores.append(distance)
        return pa.table(
            {"query_id": np.concatenate(heads), "vec_id": np.concatenate(tails), "score": np.concatenate(scores)}, schema=schema
        )

    return search


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    values = vectors.combine_chunks().flatten()
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """The k nearest found for each query: query_id, rank, vec_id, score.

    `vectors` has vec_id and embedding; `is_query` picks the queries among its rows. The
    score is the Euclidean distance in double precision; nearest first, ties to the smaller
    vec_id; a query never finds its own id. With fewer candidates all of them are found.

    Vectors that are null, empty, zero, or hold null or non-finite components take no part,
    nor do rows without an id. Vectors meet those of their own length only. Of rows that
    repeat an id, that with the greatest vector counts. An empty table gives no rows. Other
    columns are ignored.
    """
    ship(vectors.sparkSession)
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("embedding")))
    rows = rows.groupBy("vec_id").agg(F.max("embedding").alias("embedding"), F.max("asks").alias("asks"))
    rows = written(rows.withColumn("width", F.size("embedding")))
    sizes = rows.groupBy("width").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asks").cast("int")).alias("q"))
    parts = sizes.select(
        "width", F.ceil(F.col("n") / shard_rows).alias("shards"), F.ceil(F.greatest("q", F.lit(1)) / query_rows).alias("blocks")
    )
    dealt = rows.join(F.broadcast(parts), "width")
    shard = F.pmod(F.xxhash64("vec_id"), F.col("shards"))
    block = F.pmod(F.xxhash64("vec_id", F.lit("query")), F.col("blocks"))
    left = dealt.withColumn("shard", shard).withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    right = dealt.filter("asks").withColumn("block", block)
    right = right.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shards") - 1)))
    cell = ["width", "shard", "block"]
    columns = [*cell, "vec_id", "embedding"]
    asked = right.select(*[F.col(c).alias(f"q_{c}") for c in columns]).groupBy(*[f"q_{c}" for c in cell])
    found = left.select(*columns).groupBy(*cell).cogroup(asked).applyInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def missed(n: int = DIRECTIONS, threshold: int = THRESHOLD) -> float:
    """Probability that a vector at the radius stays under the collision threshold."""
    p = math.erf(WIDTH / 2 / math.sqrt(2))
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(threshold))
