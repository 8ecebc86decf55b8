"""Nearest neighbours by collision counting over sorted projections.

Every vector is projected on a fixed number of random directions. A block of the index holds its vectors and, for each
direction, their projections in sorted order. A query opens a window around its own projection in every sorted array.
Virtual rehashing widens all windows together, radius by radius, and only what a window newly covers is counted. A
vector whose collisions reach the threshold is verified on the original vectors. A query is done with a block when its
k-th verified distance is no larger than the radius, as the threshold is chosen so that a vector at that distance
misses it with probability `miss` at most. Once k vectors are verified, the next radius is the k-th distance itself.

Blocks and queries are dealt by hash: each block meets each part of the queries in a task of its own, and leaves at most
k rows per query. Vectors are moved, not index blocks: the task that searches a block sorts its projections first, which
takes far less time than the search. So no row is larger than a vector, and a block is copied only as often as its
queries do not fit one task, or as blocks alone are too few for the cores. Directions and threshold depend on the
dimension and a seed only; nothing is fitted to the data, and every vector is indexed. A sample of random directions, of
fixed size, measures how many collisions a distance gives.

Defined results: vectors that are NULL, empty, zero or hold NULL or non-finite components take no part. Vectors of
different dimensions are not compared. Rows without an id are no queries but can be neighbours; of equal distances the
smaller id comes first, no id last. Repeated rows are rows of their own: a query's copies are its neighbours, only the
query's own row is left out. Other columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType

from . import common

NEIGHBOURS = 10
#: Directions per dimension, half width of a window over its radius, and what a neighbour may miss the threshold by.
DIRECTIONS = 64
HALF_WIDTH = 1.5
MISS = 0.01
SEED = 20240607
#: Random differences by which the threshold is measured.
TRIALS = 20_000
#: Bytes of a block in memory; queries that meet a block in one task, and the least of them worth a task.
BLOCK_BYTES = 32 << 20
PART_QUERIES = 1 << 14
LEAST_QUERIES = 1 << 6


@lru_cache(maxsize=8)
def directions(dim: int) -> np.ndarray:
    """(dim, DIRECTIONS): random rotations, scaled so that a vector's projections have its length on average."""
    draw, found = np.random.default_rng([SEED, dim]), []
    while sum(x.shape[1] for x in found) < DIRECTIONS:
        found.append(np.linalg.qr(draw.standard_normal((dim, min(dim, DIRECTIONS))))[0])
    return np.concatenate(found, axis=1)[:, :DIRECTIONS] * np.sqrt(dim)


@lru_cache(maxsize=8)
def threshold(dim: int) -> int:
    """Collisions that all but `MISS` of the vectors at the radius have."""
    draw, counts = np.random.default_rng([SEED, dim, 1]), []
    for _ in range(0, TRIALS, 1000):
        x = draw.standard_normal((1000, dim))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        counts.append((np.abs(x @ directions(dim)) <= HALF_WIDTH).sum(1))
    return max(1, int(np.quantile(np.concatenate(counts), MISS, method="lower")))


class Block:
    """Vectors of one dimension and their sorted projections."""

    def __init__(self, vectors: np.ndarray, order: np.ndarray, values: np.ndarray):
        self.vectors, self.order, self.values = vectors, order, values
        n = len(vectors)
        spread = float(np.sqrt(np.mean(np.var(values, axis=1))))
        # The first radius also covers what two ways of adding up a projection differ by.
        self.first = max(spread / 16, 1e-9 * float(np.abs(values).max(initial=0.0)), np.finfo(float).tiny)
        self.least = threshold(vectors.shape[1])
        self.n = n

    def nearest(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, distances) of what was verified, at least the k nearest but for misses; `own` (or -1) is left out."""
        centre = query @ directions(len(query))
        count = np.zeros(self.n, np.int64)
        seen = np.zeros(self.n, bool)
        places, distances, kth, radius = [], [], np.inf, self.first
        if own >= 0:
            seen[own] = True
        low = high = np.array([np.searchsorted(v, c) for v, c in zip(self.values, centre, strict=True)])
        while True:
            reach = HALF_WIDTH * radius
            to_low = np.array([np.searchsorted(v, c) for v, c in zip(self.values, centre - reach, strict=True)])
            to_high = np.array([np.searchsorted(v, c, "right") for v, c in zip(self.values, centre + reach, strict=True)])
            to_low, to_high = np.minimum(to_low, low), np.maximum(to_high, high)
            edges = zip(self.order, to_low.tolist(), low.tolist(), high.tolist(), to_high.tolist(), strict=True)
            new = np.concatenate([x for o, a, b, c, d in edges for x in (o[a:b], o[c:d])])
            count += np.bincount(new, minlength=self.n)
            low, high = to_low, to_high
            found = np.flatnonzero((count >= self.least) & ~seen)
            if len(found):
                seen[found] = True
                places.append(found)
                distances.append(np.sqrt(np.sum((self.vectors[found] - query) ** 2, axis=1)))
                if sum(map(len, distances)) >= k:
                    kth = np.partition(np.concatenate(distances), k - 1)[k - 1]
            if kth <= radius or seen.all():
                return np.concatenate(places or [np.zeros(0, np.int64)]), np.concatenate(distances or [np.zeros(0)])
            radius = min(2 * radius, kth)


def _matrix(table: pa.Table) -> np.ndarray:
    return np.asarray(table.column("vector").combine_chunks().flatten(), np.float64).reshape(len(table), -1)


def _indexed(vectors: np.ndarray) -> Block:
    """The vectors with, per direction, the order and the sorted projections."""
    projected = (vectors @ directions(vectors.shape[1])).T
    order = np.argsort(projected, axis=1, kind="stable")
    return Block(vectors, order, np.take_along_axis(projected, order, axis=1))


FOUND_DDL = "query_row bigint, query_id bigint, vec_id bigint, score double"


def _searched(k: int):
    def run(key: tuple, held: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if len(held) and len(queries):
            ids = held.column("id").combine_chunks()
            tie = np.asarray(pa.compute.fill_null(ids, 0)), np.asarray(pa.compute.is_null(ids))
            rows = np.asarray(held.column("row").combine_chunks())
            place = {int(r): i for i, r in enumerate(rows.tolist())} if len(queries) > 8 else None
            block, wanted = _indexed(_matrix(held)), _matrix(queries)
            for q, query_id, vector in zip(queries.column("row").to_pylist(), queries.column("id").to_pylist(), wanted, strict=True):
                own = place.get(q, -1) if place is not None else int(next(iter(np.flatnonzero(rows == q)), -1))
                at, distance = block.nearest(vector, k, own)
                first = np.lexsort((tie[0][at], tie[1][at], distance))[:k]
                out["vec_id"] += ids.take(pa.array(at[first])).to_pylist()
                out["score"] += distance[first].tolist()
                out["query_row"] += [q] * len(first)
                out["query_id"] += [query_id] * len(first)
        return pa.table({c: pa.array(v, pa.float64() if c == "score" else pa.int64()) for c, v in out.items()})

    return run


def _valid(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _parts(n_queries: int, blocks: int, slices: int) -> int:
    """Parts of the queries: so many that one fits a task, and more while blocks are fewer than tasks can run at once."""
    return max(1, -(-n_queries // PART_QUERIES), min(-(-slices // blocks), n_queries // LEAST_QUERIES))


def nearest(vectors: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row that fulfils `query`, a condition on `id`."""
    given = F.col(f"`{vector_col}`")
    element = vectors.select(given).schema[0].dataType.elementType
    if not isinstance(element, FloatType | DoubleType):
        given = given.cast(ArrayType(DoubleType()))
    scratch = common.Scratch(vectors.sparkSession, "neighbours")
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), given.alias("vector")).where(_valid(F.col("vector")))
    rows = scratch.store(rows.select(F.monotonically_increasing_id().alias("row"), "id", F.size("vector").alias("dim"), "vector"), "rows")
    size = F.sum(8 * (F.col("dim").cast("bigint") + 2 * DIRECTIONS))
    n_bytes, n_queries = rows.agg(F.coalesce(size, F.lit(0)), F.count(F.when(query, 1))).first()
    blocks = max(1, -(-n_bytes // BLOCK_BYTES))
    parts = _parts(n_queries, blocks, common.slices(vectors.sparkSession))
    left = (
        rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
        .select("dim", "block", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "row", "id", "vector")
    )
    right = (
        rows.where(query).withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.lit(parts)).cast("int"))
        .select(F.col("dim").alias("q_dim"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("q_block"), F.col("part").alias("q_part"), "row", "id", "vector")
    )
    found = left.groupBy("dim", "block", "part").cogroup(right.groupBy("q_dim", "q_block", "q_part")).applyInArrow(_searched(k), FOUND_DDL)
    by = Window.partitionBy("query_row").orderBy("score", F.asc_nulls_last("vec_id"))
    best = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(common.table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)
