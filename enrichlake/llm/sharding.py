"""Sharding by best-fit-decreasing bin packing of indivisible groups.

Groups of rows (here: rows of equal text) are never split. Taken by size, largest first, each enters the bin whose
remaining capacity is the tightest that suffices; remaining capacities stand in a balanced search tree. Groups of one
size are alike, so the packing runs over the histogram of sizes: a size of n groups fills one bin after the other in
runs. Distinct sizes add up to the total, so there are at most sqrt(2 * total bytes) of them; that bounds what the
driver sees and what tasks look up. A group larger than the capacity has a bin of its own.

With a fixed capacity the number of shards is what best fit needs. With a fixed number of shards the capacity is the
least, by bisection, at which best fit needs no more: sizes are then as near to equal as groups allow.

Defined results: a NULL text has no bytes and stands in one group with empty texts; a row counts its bytes plus one.
A NULL id is an id. Repeated rows are rows of their own, with slots of their own. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SHARDS = 8


@dataclass
class Node:
    """A node of the tree: bins with `room` left, as runs (first bin, number of bins)."""

    room: int
    priority: int
    bins: list[tuple[int, int]] = field(default_factory=list)
    left: Node | None = None
    right: Node | None = None


class Rooms:
    """Remaining capacities in a treap: a search tree balanced by hashed priorities."""

    def __init__(self) -> None:
        self.root: Node | None = None

    def _split(self, node: Node | None, room: int) -> tuple[Node | None, Node | None]:
        """Nodes below `room`, and the others."""
        if node is None:
            return None, None
        if node.room < room:
            node.right, rest = self._split(node.right, room)
            return node, rest
        rest, node.left = self._split(node.left, room)
        return rest, node

    def _merge(self, a: Node | None, b: Node | None) -> Node | None:
        if a is None or b is None:
            return a or b
        if a.priority > b.priority:
            a.right = self._merge(a.right, b)
            return a
        b.left = self._merge(a, b.left)
        return b

    def tightest(self, size: int) -> Node | None:
        node, best = self.root, None
        while node:
            if node.room >= size:
                best, node = node, node.left
            else:
                node = node.right
        return best

    def add(self, room: int, run: tuple[int, int]) -> None:
        node = self.tightest(room)
        if node is None or node.room != room:
            priority = (room * 0x9E3779B97F4A7C15 + 0x7F4A7C15) * 0xD6E8FEB86659FD93 >> 17 & 0xFFFFFFFF
            node = Node(room, priority)
            low, high = self._split(self.root, room)
            self.root = self._merge(self._merge(low, node), high)
        node.bins.append(run)

    def pop(self, node: Node) -> tuple[int, int]:
        run = node.bins.pop()
        if not node.bins:
            low, rest = self._split(self.root, node.room)
            _, high = self._split(rest, node.room + 1)
            self.root = self._merge(low, high)
        return run


#: (size, rank of the first group, number of groups, first bin, groups per bin)
Run = tuple[int, int, int, int, int]


def best_fit(counts: dict[int, int], capacity: int, most: int | None = None) -> tuple[list[Run], int]:
    """Runs and number of bins; stops early beyond `most` bins."""
    rooms, runs, bins = Rooms(), [], 0
    for size in sorted(counts, reverse=True):
        rank, n = 0, counts[size]
        while n:
            if most is not None and bins > most:
                return runs, bins
            node = rooms.tightest(size)
            if node is None:
                each = max(1, capacity // size)
                first, many = bins, -(-n // each)
                bins += many
                room = max(0, capacity - size * each)
            else:
                first, many = rooms.pop(node)
                each = node.room // size
                room = node.room - size * each
            whole = min(many, n // each)
            if whole:
                runs.append((size, rank, whole * each, first, each))
                rank, n = rank + whole * each, n - whole * each
                rooms.add(room, (first, whole))
            if whole < many and n:  # the next bin of the run is filled in part
                runs.append((size, rank, min(n, each), first + whole, each))
                rooms.add(room + size * (each - min(n, each)), (first + whole, 1))
                rank, n, whole = rank + min(n, each), n - min(n, each), whole + 1
            if whole < many:
                rooms.add(room + size * each, (first + whole, many - whole))
    return runs, bins


def runs_for_shards(counts: dict[int, int], shards: int) -> list[Run]:
    """Best fit at the least capacity that needs at most `shards` bins."""
    total = sum(k * n for k, n in counts.items())
    low, high = 0, max(1, total)
    while high - low > max(1, low >> 20):
        middle = (low + high) // 2
        if middle and best_fit(counts, middle, shards)[1] <= shards:
            high = middle
        else:
            low = middle
    return best_fit(counts, high)[0]


def _placed(runs: list[Run]):
    runs = sorted(runs)
    size, start, _, first, each = (np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 5
    sizes, at = np.unique(size, return_inverse=True)
    key = (at.astype(np.int64) << 40) + start

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            group, weight, rank = b.columns
            rank = np.asarray(rank)
            i = np.searchsorted(key, (np.searchsorted(sizes, np.asarray(weight)).astype(np.int64) << 40) + rank, side="right") - 1
            shard = first[i] + (rank - start[i]) // each[i]
            yield pa.RecordBatch.from_arrays([group, pa.array(shard, pa.int32())], names=["group", "shard"])

    return run


def assign(rows: DataFrame, scratch: common.Scratch, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """Add `shard` to rows with `group` (binary, not NULL) and `size`; give either `shards` or `capacity`."""
    groups = scratch.store(rows.groupBy("group").agg(F.sum("size").alias("weight")), "groups")
    counts = {r["weight"]: r["count"] for r in groups.groupBy("weight").count().collect()}
    runs = best_fit(counts, capacity)[0] if capacity else runs_for_shards(counts, shards)
    ranked = common.number_within(groups, ["weight"], F.xxhash64("group"), ["group"], "rank")
    bins = scratch.store(ranked.select("group", "weight", "rank").mapInArrow(_placed(runs), "group binary, shard int"), "bins")
    return rows.join(bins, "group")


def shard_documents(docs: DataFrame, shards: int | None = SHARDS, capacity: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) per row; groups are rows of equal text, slots are gapless per shard."""
    scratch = common.Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = scratch.store(
        docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("group"),
        ),
        "rows",
    )
    placed = scratch.store(assign(rows, scratch, shards, capacity), "placed")
    return common.number_within(placed, ["shard"], F.xxhash64("doc_id", "group"), ["doc_id", "group"], "slot").drop("group")


def write_shards(docs: DataFrame, path: str, shards: int | None = SHARDS, capacity: int | None = None) -> None:
    """Write the documents as they are, a folder per shard.

    The text decides the shard, so every row finds it by its text alone: repeated ids and rows without one are written once.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.unhex(F.sha2(text, 256)).alias("group"))
    placed = assign(rows, common.Scratch(docs.sparkSession, "shards"), shards, capacity)
    placed.select("row.*", F.col("shard").alias("_shard")).write.partitionBy("_shard").parquet(path)


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(common.table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
