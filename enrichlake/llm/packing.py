"""Packing of token sequences by a configuration linear program.

Documents become pieces of at most `capacity` tokens. Pieces of one length are alike, so the packing is planned over
the histogram of lengths, which has at most `capacity` entries whatever the number of documents:

1. A configuration is a multiset of length classes that fits a sequence. The linear program asks for the least total
   weight of configurations that covers all pieces. It is solved by multiplicative weights: each round prices the
   classes, a knapsack dynamic program finds the best configuration at these prices, the configuration is used until
   its scarcest class is covered a little further, and the prices of what it covers fall.
2. The solution is rounded: each configuration is used a whole number of times, as far as pieces are left. Real
   pieces are shorter than their class, so what stays free is filled with the longest piece that fits.
3. Pieces that rounding leaves over go to the tightest sequence with room, longest first.

The plan says for each length which ranks go to which sequences at which offset. Pieces are numbered within their
length, in slices, and look their place up in the plan. Nothing but the histogram and the plan passes the driver.

Defined results: a NULL text counts as empty and gives one piece, the end id. Repeated rows are pieces of their own.
A NULL id is kept. Longer documents are cut into full pieces, the first piece takes the rest.
"""

from __future__ import annotations

import bisect
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, tokens

CAPACITY = 2048
END_ID = 0
#: Classes of lengths that the linear program tells apart.
CLASSES = 256
ROUNDS = 4000
EPSILON = 0.1


def cut_lengths(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of `n` ids; only the first may be shorter than `capacity`."""
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _piece_batches(path: str, capacity: int, with_ids: bool):
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    schema = pa.schema(kinds | ({"ids": pa.binary()} if with_ids else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokens.byte_level(path)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                out: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(), encoder.many(texts), strict=True):
                    ids += end
                    for k, (start, length) in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        piece = ids[4 * start : 4 * (start + length)]
                        out.append((doc, k, start, length, zlib.crc32(piece), piece))
                columns = dict(zip(("doc_id", "piece", "start", "length", "ids_crc32", "ids"), zip(*out, strict=True), strict=True))
                yield from common.rows_of([columns], schema)

    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) per piece, and its ids as little-endian bytes if asked for."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return plain.mapInArrow(_piece_batches(path, capacity, with_ids), kind)


def best_configuration(price: np.ndarray, room: int) -> Counter:
    """Unbounded knapsack over sizes 1..len(price): the multiset within `room` of greatest total price."""
    best, took = np.zeros(room + 1), np.zeros(room + 1, np.int64)
    for r in range(1, room + 1):
        k = min(r, len(price))
        gain = price[:k] + best[r - k : r][::-1]
        i = int(gain.argmax())
        best[r], took[r] = (gain[i], i + 1) if gain[i] > best[r - 1] else (best[r - 1], 0)
    out: Counter = Counter()
    while room > 0:
        if took[room]:
            out[int(took[room])] += 1
            room -= int(took[room])
        else:
            room -= 1
    return out


def configurations(demand: np.ndarray, room: int, rounds: int = ROUNDS, epsilon: float = EPSILON) -> list[tuple[tuple[int, ...], float]]:
    """Multiplicative weights for: least sum of x with every size s covered demand[s-1] times. Sizes are 1..room."""
    present = demand > 0
    if not present.any():
        return []
    covered, x = np.zeros(len(demand)), Counter()
    scale = np.where(present, np.maximum(demand, 1), 1)
    for _ in range(rounds):
        # The least covered size leads; prices fall by a factor e for each further 1 / rate of its demand.
        rate = np.log(max(2, present.sum())) / epsilon
        lead = covered[present].min()
        if lead >= 1:
            break
        price = np.where(present, np.exp(-rate * np.minimum(covered - lead, 50)) / scale, 0.0)
        found = best_configuration(price, room)
        sizes = np.array(sorted(found))
        times = np.array([found[s] for s in sizes])
        step = epsilon * float((demand[sizes - 1] / times).min())
        covered[sizes - 1] += step * times / demand[sizes - 1]
        x[tuple(sorted(found.elements(), reverse=True))] += step
    top = max(1.0, covered[present].max())  # no size is used beyond its demand
    return [(c, w / top) for c, w in x.most_common()]


class Lengths:
    """Pieces left, by length."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.order = sorted(k for k, n in counts.items() if n)

    def longest(self, at_most: int) -> int | None:
        i = bisect.bisect_right(self.order, at_most)
        return self.order[i - 1] if i else None

    def take(self, length: int, n: int) -> None:
        self.left[length] -= n
        if not self.left[length]:
            self.order.remove(length)


def _filled(pattern: list[int], times: int, room: int, lengths: Lengths) -> Iterator[tuple[tuple[int, ...], int]]:
    """Fill what is free in `times` equal sequences with the longest pieces that fit."""
    open_ = [(pattern, times, room)]
    while open_:
        held, n, free = open_.pop()
        length = lengths.longest(free)
        if length is None:
            yield tuple(held), n
            continue
        k = min(n, lengths.left[length])
        lengths.take(length, k)
        open_.append(([*held, length], k, free - length))
        if n > k:
            open_.append((held, n - k, free))


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of the pieces of a sequence, number of such sequences) for a histogram of lengths."""
    lengths = Lengths(counts)
    done: list[tuple[tuple[int, ...], int]] = []
    if n := counts.get(capacity, 0):
        lengths.take(capacity, n)
        done.append(((capacity,), n))
    unit = -(-capacity // CLASSES)
    room = capacity // unit
    demand = np.zeros(room)
    for length in lengths.order:
        demand[min(room, -(-length // unit)) - 1] += lengths.left[length]
    # Configurations whose largest piece is longest come first, as long pieces find few partners.
    for config, x in sorted(configurations(demand, room), key=lambda c: c[0], reverse=True):
        times = int(x)
        parts: list[tuple[list[int], int, int]] = [([], times, capacity)] if times else []
        for size in config:
            grown = []
            for held, n, free in parts:
                while n:
                    length = lengths.longest(min(size * unit, free))
                    if length is None or length <= (size - 1) * unit:
                        if held:
                            grown.append((held, n, free))
                        break
                    k = min(n, lengths.left[length])
                    lengths.take(length, k)
                    grown.append(([*held, length], k, free - length))
                    n -= k
            parts = grown
        for held, n, free in parts:
            done.extend(_filled(held, n, free, lengths))
    return _best_fit(done, lengths, capacity)


def _best_fit(done: list[tuple[tuple[int, ...], int]], lengths: Lengths, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Leftover pieces, longest first, each to the sequence with the least room that suffices."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for pattern, n in done:
        by_room.setdefault(capacity - sum(pattern), []).append((pattern, n))
    rooms = sorted(by_room)

    def put(room: int, entry: tuple[tuple[int, ...], int]) -> None:
        if room not in by_room:
            by_room[room] = []
            bisect.insort(rooms, room)
        by_room[room].append(entry)

    for length in reversed(lengths.order.copy()):
        n = lengths.left[length]
        while n:
            i = bisect.bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                for held, times in ((each, n // each), (n % each, 1)):
                    if held and times:
                        put(capacity - held * length, ((length,) * held, times))
                break
            room = rooms[i]
            pattern, times = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                del rooms[i]
            k = min(n, times)
            if times > k:
                put(room, (pattern, times - k))
            put(room - length, ((*pattern, length), k))
            n -= k
    return [entry for entries in by_room.values() for entry in entries]


@dataclass(frozen=True)
class Plan:
    """Runs of ranks by length: pieces `rank` to the next run's go to sequences from `sequence` on, at `offset`."""

    key: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def look_up(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (length << 44) + rank, side="right") - 1
        return self.sequence[at] + rank - (self.key[at] - (length << 44)), self.offset[at]


def plan_of(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    used: Counter = Counter()
    runs, sequence = [], 0
    for pattern, times in plan_sequences(counts, capacity):
        offset = 0
        for length in pattern:
            runs.append(((length << 44) + used[length], sequence, offset))
            used[length] += times
            offset += length
        sequence += times
    runs.sort()
    key, first, offset = (np.array(c, np.int64) for c in zip(*runs, strict=True)) if runs else (np.zeros(0, np.int64),) * 3
    return Plan(key, first, offset, sequence)


def _placed(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            columns = dict(zip(b.schema.names, b.columns, strict=True))
            rank = np.asarray(columns.pop("rank"))
            sequence, offset = plan.look_up(np.asarray(columns["length"]), rank)
            columns |= {"sequence_id": pa.array(sequence), "offset": pa.array(offset)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """A row per piece with its sequence and its offset there; with `with_ids` also the ids themselves."""
    scratch = common.Scratch(docs.sparkSession, "packing")
    cut = scratch.store(pieces(docs, path or tokens.default_path(), capacity, with_ids), "pieces")
    # At most `capacity` rows.
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    plan = plan_of(counts, capacity)
    ranked = common.number_within(cut, ["length"], F.xxhash64("doc_id", "piece", "ids_crc32"), ["doc_id", "piece", "ids_crc32"], "rank")
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id bigint, offset bigint"
    return ranked.select(*cut.columns, "rank").mapInArrow(_placed(plan), kind)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(common.table(spark, sf_dir, "documents"))
