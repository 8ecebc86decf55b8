"""Alignment of the tokens of two tokenizers over the same bytes.

Both tokenizers spell the same bytes, so each token is a byte range. Where tokens of both end at one byte, the text is
cut into groups. The cuts are found by divide and conquer: an interval looks for an end of the first tokenizer near its
middle that is an end of the second one too (by bisect, in a window that doubles until it holds one), is cut there, and
both halves go on by themselves. An interval without such an end is a leaf, and the leaves are the groups. All
intervals of a part of the texts take each step together, as arrays.

A link is a pair of tokens whose ranges overlap; within a leaf they follow from its own ends. Links are counted over the
whole corpus by pair of ids. Texts are cut into blocks, and a block's distinct pairs are few next to its links, so only
they are moved: block pairs are summed by pair, and the sums go back to the blocks.

Defined results: a NULL or empty text has no tokens, and neither has a text whose tokens do not spell it byte by byte
in both tokenizers (the second one may rewrite characters). Such rows have zeros and an empty digest. Repeated rows count
as often as they occur, a NULL id is kept. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from . import common, tokens

#: Bytes of text that a block holds; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
MARK = "▁"  # how piece files write a space
#: Neither tokenizer ever joins characters across such a space.
CUT = re.compile(r"(?<=\S) (?=\S)")
#: A longer unit is encoded by `tokenizers` itself: the faster library overflows its stack on very long runs.
LONGEST_JOINED = 64


def piece_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pair:
    """Both tokenizers of one worker: ids of texts by either, and what an id spells.

    Texts are cut into units at spaces between visible characters, where the byte-level tokenizer always begins a new
    piece and no piece of the other one has a space behind another character (checked when the model is read; if one
    had, a text would be one unit). Each distinct unit of a block is encoded once, with a space in front.
    """

    def __init__(self, byte_level: str, pieces: str):
        a = tokens.ByteLevel(byte_level)
        self.fast, self.whole = a.encoding, a.whole
        self.whole.encode_special_tokens = True  # their strings in a text are plain text
        chars = tokens._byte_of_char()
        names = [self.whole.id_to_token(i) or "" for i in range(self.whole.get_vocab_size())]
        self.a_spelt = [bytes(chars[c] for c in x) if all(c in chars for c in x) else x.encode() for x in names]
        self.model = sentencepiece.SentencePieceProcessor(model_file=pieces)
        names_b = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.b_spelt = [
            bytes([int(p[3:-1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names_b)
        ]
        self.apart = not any(MARK in p.lstrip(MARK) for p in names_b)
        self.a_size = np.array([len(x) for x in self.a_spelt], np.int64)
        self.b_size = np.array([len(x) for x in self.b_spelt], np.int64)
        # Decimal ids with what follows them in the digest, within a side and at its end.
        self.a_text = np.array([b"%d%s" % (i, e) for e in (b",", b"|") for i in range(len(names))], object)
        self.b_text = np.array([b"%d%s" % (i, e) for e in (b",", b";") for i in range(len(names_b))], object)

    def _a_ids(self, units: list[str], spelt: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units behind each other, and their number per unit."""
        short = np.array([len(u) <= LONGEST_JOINED for u in units], bool)
        text = "".join([" " + u for u in units if len(u) <= LONGEST_JOINED])
        ids = np.array(self.fast.encode_ordinary(text), np.int64)
        ends = np.cumsum([len(x) for x, s in zip(spelt, short, strict=True) if s], dtype=np.int64)
        upto = np.searchsorted(np.cumsum(self.a_size[ids]), ends) + 1
        n = np.zeros(len(units), np.int64)
        n[short] = np.diff(upto, prepend=0)
        if short.all():
            return ids, n
        pieces, at = [], 0
        for i, u in enumerate(units):
            if not short[i]:
                found = np.array(self.whole.encode(" " + u, add_special_tokens=False).ids, np.int64)
                n[i] = len(found)
                pieces += [ids[at : upto[np.count_nonzero(short[:i]) - 1] if short[:i].any() else 0], found]
                at = upto[np.count_nonzero(short[:i]) - 1] if short[:i].any() else 0
        return np.concatenate([*pieces, ids[at:]]), n

    def _spells(self, ids: np.ndarray, n: np.ndarray, by: list[bytes], spelt: list[bytes]) -> np.ndarray:
        """Whether the ids of each unit spell it."""
        made = [by[i] for i in ids.tolist()]
        if b"".join(made) == b"".join(spelt) and len(made):
            sizes = np.fromiter(map(len, made), np.int64, len(made))
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum(n)]
            if np.array_equal(ends, np.cumsum([len(x) for x in spelt])):
                return np.ones(len(spelt), bool)
        ends = np.cumsum(n)
        each = zip((ends - n).tolist(), ends.tolist(), spelt, strict=True)
        return np.array([b"".join(made[s:e]) == x for s, e, x in each], bool)

    def ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids by both, each with their number per text; none for a text that either does not spell."""
        cut = [(CUT.split(t.decode()) if self.apart else [t.decode()]) if t else [] for t in texts]
        of = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        coded = pa.array([u for c in cut for u in c], pa.large_string()).dictionary_encode()
        code, units = np.asarray(coded.indices).astype(np.int64), coded.dictionary.to_pylist()
        spelt = [b" " + u.encode() for u in units]
        a, n_a = self._a_ids(units, spelt)
        by_unit = self.model.encode(units, num_threads=1) if units else []
        n_b = np.array([len(x) for x in by_unit], np.int64)
        b = np.array([i for x in by_unit for i in x], np.int64)
        good = self._spells(a, n_a, self.a_spelt, spelt) & self._spells(b, n_b, self.b_spelt, spelt)
        fine = np.ones(len(texts), bool)
        fine[of[~good[code]]] = False
        code, of = code[fine[of]], of[fine[of]]
        out = []
        for ids, n in ((a, n_a), (b, n_b)):
            at, _ = ranges((np.cumsum(n) - n)[code], n[code])
            out += [ids[at], np.bincount(of, n[code], len(texts)).astype(np.int64)]
        return tuple(out)


@lru_cache(maxsize=2)
def pair(byte_level: str, pieces: str) -> Pair:
    """One per worker process."""
    return Pair(byte_level, pieces)


def ranges(lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers lo..lo+n-1 of each range behind each other, and the range each belongs to."""
    of = np.repeat(np.arange(len(lo)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + lo[of], of


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Where groups end, as places in `ends_a` behind a group's last token, ascending.

    `lo` and `hi` bound the first tokenizer's tokens of each text; texts follow each other on one line of bytes, so that
    both arrays ascend, and both have an end at the end of each text.
    """
    last = len(ends_b) - 1
    leaves, reach = [hi], np.zeros(len(lo), np.int64)
    more = hi - lo > 1
    lo, hi, reach = lo[more], hi[more], reach[more]
    while len(lo):
        middle = (lo + hi - 2) // 2
        left, right = np.maximum(lo, middle - reach), np.minimum(hi - 2, middle + reach)
        at, of = ranges(left, np.maximum(right - left + 1, 0))
        found = ends_b[np.minimum(np.searchsorted(ends_b, ends_a[at]), last)] == ends_a[at]
        at, of = at[found], of[found]
        if reach.any():
            near = np.lexsort((np.abs(at - middle[of]), of))
            at, of = at[near], of[near]
            first = np.flatnonzero(np.diff(of, prepend=-1))
            at, of = at[first], of[first]
        cut = at + 1
        leaves.append(cut)
        wider = (left > lo) | (right < hi - 2)  # ends that were not looked at yet
        wider[of] = False
        new_lo = np.concatenate([lo[of], cut, lo[wider]])
        new_hi = np.concatenate([cut, hi[of], hi[wider]])
        reach = np.concatenate([np.zeros(2 * len(of), np.int64), 2 * reach[wider] + 1])
        more = np.flatnonzero(new_hi - new_lo > 1)
        more = more[np.argsort(new_lo[more])]  # neighbouring ends are looked up one after the other
        lo, hi, reach = new_lo[more], new_hi[more], reach[more]
    return np.sort(np.concatenate(leaves))


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the tokens of all links, in the order of the text; `group_*` are the ends of the groups as places."""
    n_a, n_b = np.diff(group_a, prepend=0), np.diff(group_b, prepend=0)
    single = (n_a == 1) & (n_b == 1)
    rest_a, _ = ranges((group_a - n_a)[~single], n_a[~single])
    rest_b, _ = ranges((group_b - n_b)[~single], n_b[~single])
    # Within a leaf each byte where a token of either ends closes the overlap of two tokens.
    closes = np.union1d(ends_a[rest_a], ends_b[rest_b])
    a = np.concatenate([group_a[single] - 1, np.searchsorted(ends_a, closes)])
    b = np.concatenate([group_b[single] - 1, np.searchsorted(ends_b, closes)])
    order = np.lexsort((b, a))
    return a[order], b[order]


class Aligned:
    """The tokens, groups and links of some texts."""

    def __init__(self, both: Pair, texts: list[bytes]):
        self.both = both
        self.a, self.n_a, self.b, self.n_b = both.ids(texts)
        self.end_a, self.end_b = np.cumsum(self.n_a), np.cumsum(self.n_b)
        ends_a, ends_b = np.cumsum(both.a_size[self.a]), np.cumsum(both.b_size[self.b])
        some = self.n_a > 0
        if some.any():
            self.group_a = shared_cuts(ends_a, ends_b, (self.end_a - self.n_a)[some], self.end_a[some])
            self.group_b = np.searchsorted(ends_b, ends_a[self.group_a - 1]) + 1
            self.link_a, self.link_b = overlaps(ends_a, ends_b, self.group_a, self.group_b)
        else:
            self.group_a = self.group_b = self.link_a = self.link_b = np.zeros(0, np.int64)
        self.group_end = np.searchsorted(self.group_a, self.end_a, "right")
        self.link_end = np.searchsorted(self.link_a, self.end_a)

    def digests(self) -> list[str]:
        """SHA-256 of the groups of each text in decimal; empty without tokens."""
        n_a, n_b = np.diff(self.group_a, prepend=0), np.diff(self.group_b, prepend=0)
        closes_a, closes_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        closes_a[self.group_a - 1] = 1
        closes_b[self.group_b - 1] = 1
        out = np.empty(len(self.a) + len(self.b), object)
        # A token stands behind all of the other side's groups before its own (and, for the second, behind its own).
        out[np.arange(len(self.a)) + np.repeat(self.group_b - n_b, n_a)] = self.both.a_text[self.a + closes_a * len(self.both.a_size)]
        out[np.arange(len(self.b)) + np.repeat(self.group_a, n_b)] = self.both.b_text[self.b + closes_b * len(self.both.b_size)]
        ends = self.end_a + self.end_b
        return [
            hashlib.sha256(b"".join(out[s:e].tolist())[:-1]).hexdigest() if e > s else ""
            for s, e in zip((ends - self.n_a - self.n_b).tolist(), ends.tolist(), strict=True)
        ]


def _lists(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, kind))


def _groups(byte_level: str, pieces: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = pair(byte_level, pieces)
        for batch in batches:
            for part, texts in common.parts(batch, "text", BLOCK_BYTES):
                x = Aligned(both, texts)
                starts = np.concatenate([[0], x.group_end[:-1]])
                n = x.group_end - starts
                # Group ends counted from the text's own first token.
                own_a = x.group_a - np.repeat(x.end_a - x.n_a, n)
                own_b = x.group_b - np.repeat(x.end_b - x.n_b, n)
                columns = [_lists(x.a, x.end_a, pa.int32()), _lists(x.b, x.end_b, pa.int32())]
                columns += [_lists(own_a, x.group_end, pa.int32()), _lists(own_b, x.group_end, pa.int32())]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["id", "a", "b", "a_ends", "b_ends"])

    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Per text: ids by both tokenizers (a, b) and where each group ends in either (a_ends, b_ends)."""
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    lists = [StructField(c, ArrayType(IntegerType())) for c in ("a", "b", "a_ends", "b_ends")]
    schema = StructType([StructField("id", plain.schema["id"].dataType), *lists])
    return plain.mapInArrow(_groups(byte_level or tokens.default_path(), pieces or piece_path()), schema)


MEASURES = ("n_a", "n_b", "n_groups", "n_links")


def _blocks(byte_level: str, pieces: str):
    """One row per block: its distinct pairs with their links, and its texts with their pairs by place in that list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        both, block = pair(byte_level, pieces), TaskContext.get().partitionId() << 32
        for batch in batches:
            for part, texts in common.parts(batch, "text", BLOCK_BYTES):
                x = Aligned(both, texts)
                starts = np.concatenate([[0], x.link_end[:-1]])
                links = x.link_end - starts
                pairs, at, times = np.unique(x.a[x.link_a] << 32 | x.b[x.link_b], return_inverse=True, return_counts=True)
                own, own_times = np.unique(np.repeat(np.arange(len(texts)), links) * max(1, len(pairs)) + at, return_counts=True)
                own_end = np.searchsorted(own, np.arange(1, len(texts) + 1) * max(1, len(pairs)))
                n_groups = np.diff(x.group_end, prepend=0)
                columns = {"id": part.column(0)}
                columns |= {k: pa.array(v, pa.int64()) for k, v in zip(MEASURES, (x.n_a, x.n_b, n_groups, links), strict=True)}
                columns["groups_sha256"] = pa.array(x.digests(), pa.string())
                columns["at"] = _lists(own % max(1, len(pairs)), own_end, pa.int32())
                columns["times"] = _lists(own_times, own_end, pa.int32())
                rows = pa.StructArray.from_arrays(list(columns.values()), names=list(columns))
                whole = np.array([len(texts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], pa.int64()),
                        _lists(pairs, np.array([len(pairs)]), pa.int64()),
                        _lists(times, np.array([len(pairs)]), pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, *whole], pa.int32()), rows),
                    ],
                    names=["block", "pairs", "links", "texts"],
                )
                block += 1

    return run


def _shared_out(key: tuple, blocks: pa.Table, sums: pa.Table) -> pa.Table:
    """Corpus counts of a block's pairs, summed up for each of its texts."""
    texts = blocks.column("texts").combine_chunks().flatten()
    order = np.asarray(sums.column("place")).argsort()
    count = np.asarray(sums.column("count"))[order]
    best = np.asarray(sums.column("best"))[order].astype(np.int64)
    at, times = (texts.field(c) for c in ("at", "times"))
    places, times = np.asarray(at.flatten()), np.asarray(times.flatten()).astype(np.int64)
    ends = np.cumsum(np.asarray(pa.compute.list_value_length(at)))
    out = {c: texts.field(c) for c in ("id", *MEASURES, "groups_sha256")}
    for name, value in (("n_best", best), ("count_sum", count)):
        upto = np.concatenate([[0], np.cumsum(value[places] * times)])
        out[name] = pa.array(np.diff(upto[ends], prepend=0), pa.int64())
    return pa.table(out)


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_level: str | None = None, pieces: str | None = None) -> DataFrame:
    """Per text: numbers of tokens, groups and links, links that are their second id's most frequent, sum of counts."""
    plain = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_field = StructField("id", plain.schema["id"].dataType)
    measures = [StructField(c, LongType()) for c in MEASURES]
    digest = StructField("groups_sha256", StringType())
    lists = [StructField(c, ArrayType(IntegerType())) for c in ("at", "times")]
    row = StructType([id_field, *measures, digest, *lists])
    kind = StructType(
        [
            StructField("block", LongType()),
            StructField("pairs", ArrayType(LongType())),
            StructField("links", ArrayType(LongType())),
            StructField("texts", ArrayType(row)),
        ]
    )
    scratch = common.Scratch(docs.sparkSession, "alignment")
    blocks = scratch.store(plain.mapInArrow(_blocks(byte_level or tokens.default_path(), pieces or piece_path()), kind), "blocks")
    each = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "links")).alias("place", "x")).select(
        "block", "place", F.col("x.pairs").alias("pair"), F.col("x.links").alias("n")
    )
    sums = scratch.store(each.groupBy("pair").agg(F.sum("n").alias("count")), "sums")
    second = sums.withColumn("b", F.expr("pair & 4294967295"))
    most = second.groupBy("b").agg(F.max("count").alias("most"))
    known = second.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    back = each.select("block", "place", "pair").join(known, "pair").select("block", "place", "count", "best")
    out = StructType([id_field, *measures, digest, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    return blocks.select(F.col("block").alias("of"), "texts").groupBy("of").cogroup(back.groupBy("block")).applyInArrow(_shared_out, out)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(common.table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").withColumn("doc_id", F.col("doc_id").cast("bigint"))
