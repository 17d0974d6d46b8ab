"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stop.

Vectors are dealt into shards and projected by Gaussian numbers to a few dimensions, where a
kd-tree holds them. A query takes its projected neighbours in order of their distance and
verifies each on the original vectors. A squared projected distance is the true one times a
chi-square variable, so once the next projected distance is so large, against the k-th best
true one, that a nearer vector would have come earlier with the wanted probability, the
search of the shard stops. Every row is indexed; the best of all shards are merged.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, exp, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom.llm.cells import meet_in_cells


@dataclass(frozen=True)
class Settings:
    """``dimensions`` is even; ``confidence`` is the chance that a near vector is not missed."""

    dimensions: int = 8
    confidence: float = 0.95
    leaf: int = 32
    shard_rows: int = 16_384
    seed: int = 5


def chi_square_cdf(x: float, dimensions: int) -> float:
    """For an even number of dimensions."""
    half = x / 2
    if half > 700:
        return 1.0
    return 1 - exp(-half) * sum(half**i / factorial(i) for i in range(dimensions // 2))


def chi_square_quantile(p: float, dimensions: int) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square_cdf(middle, dimensions) < p else (low, middle)
    return high


class ProjectedTree:
    """Vectors (rows of doubles) in a kd-tree over their projections; leaves are boxes of rows.

    The rows of a leaf are stored side by side. ``verified`` counts the original vectors read by all searches.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        self.axes = rng.normal(size=(vectors.shape[1], settings.dimensions))
        self.points = vectors @ self.axes
        self.verified = 0
        self.stop = chi_square_quantile(settings.confidence, settings.dimensions)
        leaves, waiting = [], [np.arange(len(ids))]
        while waiting:
            rows = waiting.pop()
            own = self.points[rows]
            spread = own.max(axis=0) - own.min(axis=0)
            if len(rows) <= settings.leaf or not spread.any():
                leaves.append(rows)
                continue
            half = len(rows) // 2
            order = np.argpartition(own[:, spread.argmax()], half)
            waiting += [rows[order[:half]], rows[order[half:]]]
        self.low = np.array([self.points[rows].min(axis=0) for rows in leaves])
        self.high = np.array([self.points[rows].max(axis=0) for rows in leaves])
        order = np.concatenate(leaves)
        self.ids, self.vectors, self.points = ids[order], vectors[order], self.points[order]
        edges = np.cumsum([0, *map(len, leaves)])
        self.leaves = [np.arange(first, last) for first, last in zip(edges[:-1], edges[1:])]

    def nearest(self, own_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest found, ties by id; the row ``own_id`` is left out."""
        place = query @ self.axes
        gap = np.maximum(0, np.maximum(self.low - place, place - self.high))
        bound = (gap * gap).sum(axis=1)
        order = np.argsort(bound, kind="stable")
        best_ids, best = np.zeros(0, self.ids.dtype), np.zeros(0)
        rows, far = np.zeros(0, np.int64), np.zeros(0)  # seen in a leaf, not verified yet
        done, width = 0, 4
        while done < len(order) or len(rows):
            opened = order[done : done + width]
            done += len(opened)
            width = min(2 * width, 256)
            if len(opened):
                fresh = np.concatenate([self.leaves[leaf] for leaf in opened])
                apart = self.points[fresh] - place
                rows = np.concatenate([rows, fresh])
                far = np.concatenate([far, (apart * apart).sum(axis=1)])
            # All that is nearer than the next leaf can be, is next in the projected order.
            reach = bound[order[done]] if done < len(order) else np.inf
            due = far <= reach
            if len(best) == k:
                due &= far <= self.stop * best[-1] ** 2
            new = rows[due]
            new = new[self.ids[new] != own_id]
            self.verified += len(new)
            apart = self.vectors[new] - query
            best_ids = np.concatenate([best_ids, self.ids[new]])
            best = np.concatenate([best, np.sqrt((apart * apart).sum(axis=1))])
            first = np.lexsort((best_ids, best))[:k]
            best_ids, best = best_ids[first], best[first]
            rows, far = rows[~due], far[~due]
            if len(best) == k:
                if min(reach, far.min(initial=np.inf)) > self.stop * best[-1] ** 2:
                    break
        return best_ids, best


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite numbers and not all zero."""
    finite = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    key: str = "vec_id",
    vector: str = "embedding",
    settings: Settings = Settings(),
) -> DataFrame:
    """query_id, rank from 1, ``key``, score: the ``k`` nearest rows found for each query.

    The measure is the Euclidean distance in double precision on the original vectors, ties
    go to the smaller key, and the rows with the query's own key are no candidates. Vectors
    that are null, empty, zero or have a null or non-finite component take no part, nor does a row
    without a key; vectors meet only those of as many components. A query with fewer candidates
    gets all of them; a query that occurs in several rows is answered once. Of equal vectors
    only the ``k + 1`` smallest keys can be among any nearest ``k``, so only they are indexed as
    rows of their own. Other columns are ignored, whatever their names. No rows give no rows.
    """
    kind = rows.schema[key].dataType.simpleString()
    whole = rows.select(
        F.col(key).alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("vector"), is_query.alias("asks")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    copies = Window.partitionBy("vector").orderBy("id")
    indexed = (
        whole.select("id", "vector")
        .withColumn("copy", F.row_number().over(copies))
        .where(F.col("copy") <= k + 1)
        .select("id", "vector", F.size("vector").alias("size"))
    )
    asked = whole.where("asks").select("id", "vector", F.size("vector").alias("size")).dropDuplicates(["id"])
    shards = max(1, ceil(whole.count() / settings.shard_rows))
    # All queries meet all shards: a shard's rows are shuffled once and built into one tree, past which queries stream.
    shard = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(shards)).cast("int")
    held = indexed.select("id", "vector", "size", shard.alias("shard"))
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    sent = asked.select("id", "vector", "size", every.alias("shard"))

    def matrix(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
        column = rows.column("vector")
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)

    def build(rows: pa.Table) -> ProjectedTree:
        return ProjectedTree(rows.column("id").to_numpy(), matrix(rows), settings)

    def search(tree: ProjectedTree, queries: pa.RecordBatch) -> pa.RecordBatch:
        found: list[tuple] = []
        for own, query in zip(queries.column("id").to_pylist(), matrix(queries)):
            ids, distances = tree.nearest(own, query, k)
            found += [(own, i, d) for i, d in zip(ids.tolist(), distances.tolist())]
        columns, key_type = list(zip(*found)) or [(), (), ()], queries.schema.field("id").type
        arrays = [pa.array(columns[0], key_type), pa.array(columns[1], key_type), pa.array(columns[2], pa.float64())]
        return pa.RecordBatch.from_arrays(arrays, ["query_id", "id", "score"])

    near = meet_in_cells(
        held, sent, ["size", "shard"], shards, build, search, f"query_id {kind}, id {kind}, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score")
    )
