"""Exact deduplication against a minimal perfect hash over the digests seen before.

The index holds one slot per distinct digest. Digests are dealt to shards by their leading bits; each shard builds
a minimal perfect hash of its own (levels of bit arrays: a digest that is alone in its cell of a level is placed
there, the others go on to the next level, the rank of a placed cell is the slot). A shard is one row: the levels,
and by slot the full digest, the locator of the row that stays, its length and the size of the group. A digest that
was never indexed also lands in some slot, so a lookup counts only if all 32 bytes of the slot's digest agree.

A batch is reduced to one row per digest before anything is looked up, so a group of copies of any size costs a
shard one lookup. Members update the slot's locator and size; nonmembers are grouped by themselves and make a new
segment of the index. Both segments serve the next batch.

Equal means identical after deleting [\\x20\\x09-\\x0D]. The row with the most code points stays, then the smallest id.

Defined results: a NULL text counts as empty; all empty texts are one group. A NULL id orders behind all others. Rows
that share an id and a digest are one document: they stay or go together in `decisions`, and `kept_documents`
returns the longest of them. Rows that share only the id, or have none, are told apart by their digest. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Bits per key of a level; more bits place more keys at the first attempt.
GAMMA = 2
#: Digests that a shard holds on average.
SHARD_KEYS = 1 << 16
#: Columns of what is known about a group: digest, the row that stays, its code points, number of rows.
GROUP = "digest binary, keep_id bigint, keep_len bigint, size bigint"
SHARD = "shard bigint, seg int, levels array<binary>, digests binary, keep_ids array<bigint>, keep_lens array<bigint>, sizes array<bigint>"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in common.parts(batch, "text"):
            # A byte that continues a character is no code point of its own.
            points = [len(t) - int(np.count_nonzero((np.frombuffer(t, np.uint8) & 0xC0) == 0x80)) for t in texts]
            hashed = [hashlib.sha256(t.translate(None, common.WHITESPACE)).digest() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(points, pa.int64()), pa.array(hashed, pa.binary())], names=["id", "points", "digest"]
            )


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, points, digest) per row, in one pass over the texts."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(_digests, "id bigint, points bigint, digest binary")


def grouped(rows: DataFrame) -> DataFrame:
    """GROUP rows of digested rows; reduced within each task before rows move."""
    # Least of (points descending, id ascending); NULL ids come last.
    best = F.min(F.struct((-F.col("points")).alias("p"), F.col("id").isNull().alias("none"), F.col("id").alias("id")))
    return rows.groupBy("digest").agg(best.alias("b"), F.count(F.lit(1)).alias("size")).select(
        "digest", F.col("b.id").alias("keep_id"), (-F.col("b.p")).alias("keep_len"), "size"
    )


def _halves(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = digests.view(np.uint64).reshape(-1, 4)
    return words[:, 1], words[:, 2]


def _cell(a: np.ndarray, b: np.ndarray, level: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (common.mixed(a + b * np.uint64(2 * level + 1)) % np.uint64(bits)).astype(np.int64)


def build_levels(digests: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Minimal perfect hash of distinct 32-byte digests: (bit array per level, slot of each digest)."""
    slot, left, levels, placed = np.full(len(digests), -1, np.int64), np.arange(len(digests)), [], 0
    a, b = _halves(digests)
    while len(left):
        bits = GAMMA * len(left)
        cell = _cell(a[left], b[left], len(levels), bits)
        alone = np.bincount(cell, minlength=bits) == 1
        mine = alone[cell]
        rank = np.cumsum(alone) - 1
        slot[left[mine]] = placed + rank[cell[mine]]
        placed += int(alone.sum())
        levels.append(alone)
        left = left[~mine]
    return levels, slot


def find_slots(levels: list[np.ndarray], digests: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 where no level has it; digests that were never indexed get any slot."""
    slot, left, placed = np.full(len(digests), -1, np.int64), np.arange(len(digests)), 0
    a, b = _halves(digests)
    for level, bits in enumerate(levels):
        if not len(left):
            break
        cell = _cell(a[left], b[left], level, len(bits))
        hit = bits[cell]
        slot[left[hit]] = placed + (np.cumsum(bits) - 1)[cell[hit]]
        placed += int(bits.sum())
        left = left[~hit]
    return slot


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, 32).copy()


def _packed(levels: list[np.ndarray]) -> list[bytes]:
    return [len(x).to_bytes(8, "little") + np.packbits(x).tobytes() for x in levels]


def _unpacked(levels) -> list[np.ndarray]:
    return [np.unpackbits(np.frombuffer(x, np.uint8, offset=8), count=int.from_bytes(x[:8], "little")).astype(bool) for x in levels]


def _built_shard(groups: pd.DataFrame, segment: int) -> pd.DataFrame:
    digests = _matrix(groups["digest"])
    levels, slot = build_levels(digests)
    by_slot = groups.iloc[np.argsort(slot)]
    ids = [None if pd.isna(x) else int(x) for x in by_slot["keep_id"]]
    return pd.DataFrame({
        "shard": [groups["shard"].iloc[0]], "seg": [segment], "levels": [_packed(levels)], "digests": [digests[np.argsort(slot)].tobytes()],
        "keep_ids": [ids], "keep_lens": [by_slot["keep_len"].tolist()], "sizes": [by_slot["size"].tolist()],
    })


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))


def build_segment(groups: DataFrame, shards: int, segment: int) -> DataFrame:
    """SHARD rows for GROUP rows of distinct digests. `groups` never holds a digest twice, so shards are even."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return _built_shard(pdf, segment)

    return _sharded(groups, shards).groupBy("shard").applyInPandas(build, SHARD)


def _looked_up(shard: tuple, batch: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    found = np.zeros(len(batch), bool)
    keep_id, keep_len, size = np.full(len(batch), None, object), np.full(len(batch), -1, np.int64), np.zeros(len(batch), np.int64)
    if len(batch):
        digests = _matrix(batch["digest"])
        for row in index.itertuples():
            slots = find_slots(_unpacked(row.levels), digests)
            held = np.frombuffer(row.digests, np.uint8).reshape(-1, 32)
            at = np.flatnonzero(slots >= 0)
            at = at[(held[slots[at]] == digests[at]).all(axis=1)]
            found[at] = True
            keep_id[at] = np.array(list(row.keep_ids), object)[slots[at]]
            keep_len[at], size[at] = np.asarray(row.keep_lens)[slots[at]], np.asarray(row.sizes)[slots[at]]
    return pd.DataFrame({"digest": batch["digest"], "member": found, "old_id": pd.array([None if pd.isna(x) else int(x) for x in keep_id], "Int64"), "old_len": keep_len, "old_size": size})


def look_up(groups: DataFrame, segments: DataFrame, shards: int) -> DataFrame:
    """GROUP rows with `member` and, for members, what the index knew: old_id, old_len, old_size."""
    found = (
        _sharded(groups.select("digest"), shards)
        .groupBy("shard")
        .cogroup(segments.groupBy("shard"))
        .applyInPandas(_looked_up, "digest binary, member boolean, old_id bigint, old_len bigint, old_size bigint")
    )
    return groups.join(found, "digest")


def merged(looked: DataFrame) -> DataFrame:
    """GROUP rows after the batch: a member's slot keeps the better row of old and new."""
    new = F.struct((-F.col("keep_len")).alias("p"), F.col("keep_id").isNull().alias("none"), F.col("keep_id").alias("id"))
    old = F.struct((-F.col("old_len")).alias("p"), F.col("old_id").isNull().alias("none"), F.col("old_id").alias("id"))
    best = F.when(F.col("member"), F.least(new, old)).otherwise(new)
    return looked.select("digest", best.alias("b"), (F.col("size") + F.when(F.col("member"), F.col("old_size")).otherwise(0)).alias("size"), "member").select(
        "digest", F.col("b.id").alias("keep_id"), (-F.col("b.p")).alias("keep_len"), "size", "member"
    )


def group_documents(rows: DataFrame, scratch: common.Scratch, history: DataFrame | None = None, keys_per_shard: int = SHARD_KEYS) -> DataFrame:
    """GROUP rows over `history` and the rest of `rows`; both are digested rows.

    `history` is what an earlier run has indexed; its rows must not be in `rows`. Each digest occurs once in the result.
    """
    batch = scratch.store(grouped(rows), "batch")
    if history is None:
        return batch
    known = scratch.store(grouped(history), "history")
    shards = max(1, -(-(known.count() + batch.count()) // keys_per_shard))
    segments = scratch.store(build_segment(known, shards, 0), "index")
    looked = scratch.store(merged(look_up(batch, segments, shards)), "looked")
    # Slots that the batch did not touch stay as they are; nonmembers stand beside them.
    untouched = known.join(looked.where("member").select("digest"), "digest", "left_anti")
    return untouched.unionByName(looked.drop("member"))


def decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scratch: common.Scratch | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256.

    The rows are taken as two deliveries, dealt by a hash of the id: the first is the
    history that is indexed, the second is looked up. The result does not depend on how rows are dealt.
    """
    scratch = scratch or common.Scratch(docs.sparkSession, "exact-dedup")
    rows = scratch.store(digested(docs, id_col, text_col), "digests")
    earlier = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    groups = scratch.store(group_documents(rows.where(~earlier), scratch, rows.where(earlier)), "groups")
    # Nullsafe, as an id may be NULL. A hot digest is split by Spark on the side of the rows.
    return rows.join(groups.select("digest", "keep_id", "size"), "digest").select(
        F.col("id").alias("doc_id"),
        "keep_id",
        F.col("size").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def _text_digests(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: hashlib.sha256((t or b"").translate(None, common.WHITESPACE)).digest())


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of `docs` as they are."""
    scratch = common.Scratch(docs.sparkSession, "exact-dedup-kept")
    key = lambda c: (c.isNull().alias("_none"), F.coalesce(c, F.lit(0)).alias("_id"))
    steps = common.Scratch(docs.sparkSession, "exact-dedup")
    kept = decisions(docs, id_col, text_col, steps).where("kept")
    stay = scratch.store(kept.select(*key(F.col("doc_id")), F.unhex("text_sha256").alias("_digest")).distinct(), "stay")
    steps.drop()
    text = F.col(text_col).cast("string")
    # The join asks for keys that are not NULL; pushed below the aggregate, that would send each text to Python twice.
    digest = F.pandas_udf(_text_digests, "binary").asNondeterministic()
    rows = docs.select(
        *key(F.col(id_col).cast("bigint")),
        digest(text.cast("binary")).alias("_digest"),
        F.struct(F.coalesce(F.length(text), F.lit(0)), F.xxhash64(text)).alias("_best"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
    )
    # Of rows that share id and digest the longest is handed on; they are reduced within each task before rows move.
    one = rows.groupBy("_none", "_id", "_digest").agg(F.max_by("_row", "_best").alias("_row"))
    return one.join(stay, ["_none", "_id", "_digest"]).select("_row.*")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER best AS kept, text_sha256
FROM t WINDOW best AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id)
"""
