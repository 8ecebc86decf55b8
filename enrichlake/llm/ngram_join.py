"""Jaccard join of documents on word n-grams by grouped prefixes.

A document's set holds the hashes of its distinct n-word shingles. All sets share one order of shingles, rare ones
first; two sets that are similar enough share one of their first few shingles (their prefix). The order takes
frequencies from a table of hashed counters of fixed size, filled from all documents: any order is right, and this
one keeps passages that very many documents share out of the prefixes.

Equal sets are one node. Nodes with the same prefix and the same size form a group, and only the group's first node
stands in the inverted index. Members are checked against it; one that is not similar becomes a group of its own, with its
whole prefix in the index.

A set also has a parity sketch: bit i says whether an odd number of its hashes falls to i. Two sketches differ in no more
bits than their sets in elements, so a pair whose sketches differ too much is no candidate; this is exact, and nearly
all pairs of a family whose members are not similar to each other end there, before they are rows.

Which candidate pairs have to be compared is decided per component, as only components are asked for. First each
group is compared with one group that shares most of its prefix, in rounds, which joins nearly all of a family of
near copies at a cost linear in its size. Then every remaining pair of groups that shares a prefix shingle, fits in
size and lies in different components is compared. Jaccard distance is a metric, so a pair of groups is expanded
into members only if first nodes are near enough for any two members to be similar. No link is lost that could join
two components.

Defined results: NULL and empty texts have no set and are linked with nothing. A text of fewer than n words is one
shingle. An id that several texts share is linked by any of them. Rows without an id are not linked and have no component.
Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .components import components

WORDS = 3
#: Similarity as whole percent.
PERCENT = 90
#: Counters of the frequency table and the number of rows that carry it.
COUNTERS, CHUNKS = 1 << 21, 64
#: Rounds go on while at least one in so many comparisons links two components.
LEAST_GAIN = 100
#: The index is built in so many parts of the shingles: the shuffles of one part are on disk at a time.
INDEX_PARTS = 4
#: Bits of a parity sketch, and bytes of sets that a worker keeps while it compares.
SKETCH_BITS = 512
KEPT_BYTES = 32 << 20
STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    split = [t.lower().split() for t in texts]
    codes, vocabulary, ends = common.word_codes(split)
    by_code = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary.to_pylist()], np.uint64)
    h = by_code[codes] if len(codes) else np.zeros(0, np.uint64)
    out, start = [], 0
    with np.errstate(over="ignore"):
        rolled = common.mixed(h)
        for k in range(1, words):
            rolled = common.mixed(rolled[: max(0, len(h) - k)] * STEP + h[k:])
        for end in ends.tolist():
            n = end - start
            if n >= words:
                out.append(np.unique(rolled[start : end - words + 1]))
            elif n:
                short = common.mixed(h[start : start + 1])
                for k in range(1, n):
                    short = common.mixed(short * STEP + h[start + k : start + k + 1])
                out.append(short)
            else:
                out.append(np.zeros(0, np.uint64))
            start = end
    return out


def needed(n: int, m: int, percent: int) -> int:
    """Least overlap of sets of n and m that makes them similar: 100 i >= percent (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n + (percent * n) // -100 + 1 if n else 0


def enough(n: Column, m: Column, shared: Column, percent: int) -> Column:
    """Whether sets of n and m that share `shared` prefix shingles can be similar.

    Of two sets, the one whose prefix ends first in the common order shares no more than `shared` of its prefix and
    the rest of its set.
    """
    rest = lambda k: -F.floor(-percent * k / 100) - 1  # noqa: E731  what lies behind the prefix
    least = -F.floor(-percent * (n + m) / (100 + percent))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (shared + F.greatest(rest(n), rest(m)) >= least)


def sketch(hashes: np.ndarray) -> np.ndarray:
    odd = np.bincount((hashes & np.uint64(SKETCH_BITS - 1)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def least_distance(n: Column, m: Column, x: Column, y: Column) -> Column:
    """No Jaccard distance of sets of n and m elements with these sketches is smaller."""
    apart = sum((F.bit_count(x[i].bitwiseXOR(y[i])) for i in range(1, SKETCH_BITS // 64)), F.bit_count(x[0].bitwiseXOR(y[0])))
    return 2 * apart / (n + m + apart)


def _counters(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, np.int64)
        shift = np.uint64(64 - COUNTERS.bit_length() + 1)
        for batch in batches:
            for _, texts in common.parts(batch, "text"):
                sets = shingle_sets(texts, words)
                counts += np.bincount((np.concatenate(sets) >> shift).astype(np.int64), minlength=COUNTERS)
        cut = counts.reshape(CHUNKS, -1)
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(CHUNKS), pa.int32()), pa.array([task] * CHUNKS, pa.int64()), pa.array([zstandard.compress(c.tobytes(), 1) for c in cut], pa.binary())],
            names=["chunk", "task", "counts"],
        )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by (chunk, task); a task holds as many sums as it has keys."""
    total: dict[tuple, np.ndarray] = {}
    for b in batches:
        for chunk, task, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
            got = np.frombuffer(zstandard.decompress(counts), np.int64)
            total[chunk, task] = total[chunk, task] + got if (chunk, task) in total else got
    yield pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int64()), pa.array([zstandard.compress(v.tobytes(), 1) for v in total.values()], pa.binary())],
        names=["chunk", "task", "counts"],
    )


def frequencies(plain: DataFrame, words: int) -> np.ndarray:
    """How many documents hold a shingle, by counter; COUNTERS numbers, whatever the size of the corpus."""
    kind = "chunk int, task bigint, counts binary"
    rows = plain.select("text").mapInArrow(_counters(words), kind)
    for fan_in in (64, 64, 1 << 40):  # a tree, so that no task reads the rows of very many
        rows = rows.withColumn("task", F.floor(F.col("task") / fan_in)).repartition("chunk", "task").mapInArrow(_added, kind)
    found = {r["chunk"]: np.frombuffer(zstandard.decompress(bytes(r["counts"])), np.int64) for r in rows.collect()}
    return np.concatenate([found[i] for i in range(CHUNKS)])


def _prefixed(frequency: np.ndarray, words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = np.uint64(64 - COUNTERS.bit_length() + 1)
        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                sets = shingle_sets(texts, words)
                heads, keys = [], []
                for s in sets:
                    p = prefix_length(len(s), percent)
                    head = s[np.lexsort((s, frequency[(s >> shift).astype(np.int64)]))[:p]].view(np.int64)
                    heads.append(head)
                    keys.append(hashlib.blake2b(head.tobytes() + len(s).to_bytes(8, "little"), digest_size=16).digest())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        pa.array(keys, pa.binary()),
                        pa.array(heads, pa.list_(pa.int64())),
                        pa.array([sketch(s) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n", "sig", "pkey", "prefix", "sketch"],
                )

    return run


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in common.parts(batch, "text"):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([zstandard.compress(t, 1) for t in texts], pa.binary())], names=["node", "packed"])


def _compared(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, left, right = batch.columns
            held: dict[bytes, np.ndarray] = {}
            for start in range(0, len(a), 64):
                packed = [*left.slice(start, 64).to_pylist(), *right.slice(start, 64).to_pylist()]
                fresh = [x for x in dict.fromkeys(packed) if x not in held]
                if sum(x.nbytes for x in held.values()) > KEPT_BYTES:
                    held, fresh = {}, list(dict.fromkeys(packed))
                held |= zip(fresh, shingle_sets([zstandard.decompress(x) for x in fresh], words), strict=True)
                n = len(packed) // 2
                pairs = [(held[packed[i]], held[packed[n + i]]) for i in range(n)]
                inter = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in pairs]
                yield pa.RecordBatch.from_arrays(
                    [a.slice(start, n), b.slice(start, n), pa.array(inter, pa.int64()), pa.array([len(x) + len(y) for x, y in pairs], pa.int64())],
                    names=["a", "b", "inter", "both"],
                )

    return run


def hopeful(apart: DataFrame, percent: int) -> DataFrame:
    """(head, n, main, lead, c): open shingles of a head by component and lead, where all of the component's suffice.

    Heads that share single shingles by chance end here, before they meet the sketch of a lead; their number grows
    faster than the input.
    """
    enough_of = apart.groupBy("head", "n", "main").agg(F.count(F.lit(1)).alias("all")).where(enough(F.col("n"), F.col("n"), F.col("all"), percent))
    by_lead = apart.groupBy("head", "n", "main", "lead").agg(F.count(F.lit(1)).alias("c"))
    return by_lead.join(enough_of.drop("all"), ["head", "n", "main"], "left_semi")


class Join:
    """The steps of one join; tables go to the run's scratch folder and are dropped when no later step reads them."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, words: int, percent: int):
        self.scratch = common.Scratch(docs.sparkSession, "ngram-join")
        self.words, self.percent = words, percent
        self.plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.links: list[DataFrame] = []
        self.compared = 0

    def compare(self, pairs: DataFrame) -> DataFrame:
        """(a, b, inter, both, distance, linked) for pairs (a, b) of nodes."""
        self.compared += 1
        pairs = self.scratch.store(pairs, f"pairs-{self.compared}")
        # Only texts that are compared now are moved, each once; a node of very many pairs is split by Spark in the joins behind.
        now = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        texts = self.scratch.store(self.texts.join(now, "node", "left_semi"), f"texts-{self.compared}")
        joined = (
            pairs.join(texts.select(F.col("node").alias("a"), F.col("packed").alias("left")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("packed").alias("right")), "b")
            .select("a", "b", "left", "right")
        )
        found = joined.mapInArrow(_compared(self.words), "a bigint, b bigint, inter bigint, both bigint")
        found = self.scratch.store(found, f"compared-{self.compared}")
        self.scratch.drop(f"pairs-{self.compared}", f"texts-{self.compared}")
        union = F.col("both") - F.col("inter")
        found = found.withColumns({"distance": 1 - F.col("inter") / union, "linked": 100 * F.col("inter") >= self.percent * union})
        self.links.append(found.where("linked").select("a", "b"))
        return found

    def current(self, name: str) -> DataFrame:
        edges = self.links[0]
        for more in self.links[1:]:
            edges = edges.unionByName(more)
        return components(edges, self.scratch, name)

    def prepare(self) -> None:
        frequency = frequencies(self.plain, self.words)
        kind = "doc_id bigint, n bigint, sig binary, pkey binary, prefix array<bigint>, sketch array<bigint>"
        rows = self.scratch.store(self.plain.mapInArrow(_prefixed(frequency, self.words, self.percent), kind), "rows")
        self.rows = self.scratch.store(rows.select("doc_id", "n", "sig"), "sets")
        named = rows.where("n > 0 AND doc_id IS NOT NULL")
        first = F.min(F.struct("doc_id", "pkey", "n", "sketch")).alias("f")
        nodes = named.groupBy("sig").agg(first).select("sig", F.col("f.doc_id").alias("node"), "f.pkey", "f.n", "f.sketch")
        self.nodes = self.scratch.store(nodes, "nodes")
        groups = self.nodes.groupBy("pkey").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("members"))
        self.groups = self.scratch.store(groups, "groups")
        # The index: a row for each prefix shingle of each group, if another group has it too.
        heads = self.groups.join(self.nodes.select("node", "pkey", "n"), "pkey").where("node = head").select("head", "n")
        whole = named.select(F.col("doc_id").alias("head"), "n", "prefix").join(heads, ["head", "n"], "left_semi")
        self.whole = self.scratch.store(whole, "whole")
        self.scratch.drop("rows")
        parts = []
        for i in range(INDEX_PARTS):
            prefixes = self.whole.select("head", "n", F.explode("prefix").alias("token")).where(F.pmod("token", F.lit(INDEX_PARTS)) == i)
            shared = prefixes.groupBy("token").agg(F.min("head").alias("lo"), F.max("head").alias("hi")).where("lo < hi")
            parts.append(self.scratch.store(prefixes.join(shared.select("token"), "token", "left_semi"), f"index-{i}"))
        self.index = reduce(DataFrame.unionByName, parts)
        wanted = (
            self.index.select(F.col("head").alias("node"))
            .unionByName(self.groups.where("members > 1").join(self.nodes, "pkey").select("node"))
            .distinct()
        )
        # Texts that are compared at all, kept compressed: every later join moves these only.
        near = self.plain.join(wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
        self.texts = self.scratch.bucketed(near.mapInArrow(_compressed, "node bigint, packed binary"), "texts", "node")

    def members(self) -> None:
        """Compare members with the head of their group; those that are not similar to it head a group of their own."""
        pairs = self.groups.where("members > 1").join(self.nodes, "pkey").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
        found = self.compare(pairs)
        self.inside = self.scratch.store(
            found.select(F.col("a").alias("node"), F.when(F.col("linked"), F.col("b")).otherwise(F.col("a")).alias("head"), F.when(F.col("linked"), F.col("distance")).otherwise(0.0).alias("reach")),
            "inside",
        )
        # A stray shares its whole prefix with its head: all of it is held by two heads now, also what no other group has.
        strays = found.where("NOT linked").select(F.col("a").alias("stray"), F.col("b").alias("head"))
        own = self.whole.join(strays.select("head").distinct(), "head", "left_semi")
        own = own.unionByName(own.join(strays, "head").select(F.col("stray").alias("head"), "n", "prefix"))
        own = own.select("head", "n", F.explode("prefix").alias("token")).select(self.index.columns)
        rows = self.scratch.store(self.index.unionByName(own), "index-all").distinct()
        # How often others hold what a head holds: of a family, the text it stems from holds the most.
        held = rows.groupBy("token").agg(F.count(F.lit(1)).alias("holders"))
        fame = rows.join(held, "token").groupBy("head").agg(F.sum("holders").alias("fame"))
        self.index = self.scratch.store(rows.join(fame, "head"), "index-fame")
        self.scratch.drop("whole", "index-all", *(f"index-{i}" for i in range(INDEX_PARTS)))
        # What a head's node is like: an id may have several texts, and so several sketches and sizes.
        reach = self.inside.where("node <> head").groupBy("head").agg(F.max("reach").alias("reach"))
        self.like = self.scratch.store(
            self.nodes.select(F.col("node").alias("head"), "n", "sketch").join(reach, "head", "left").na.fill(0.0, ["reach"]), "like"
        )

    def open_tokens(self, labels: DataFrame, name: str) -> DataFrame:
        """Index rows of the shingles that several components share, with the largest component of the shingle."""
        with_label = self.index.join(labels.select(F.col("node").alias("head"), "component"), "head", "left")
        rows = self.scratch.store(with_label.withColumn("component", F.coalesce("component", "head")), f"{name}-rows")
        known = F.max(F.struct("fame", (-F.col("head")).alias("minus")))
        counts = rows.groupBy("token", "component").agg(F.count(F.lit(1)).alias("c"), known.alias("known"))
        tokens = (
            counts.groupBy("token")
            .agg(F.max(F.struct("c", "known", "component")).alias("top"), F.sum("c").alias("total"), F.count(F.lit(1)).alias("parts"))
            .where("parts > 1")
            .select("token", F.col("top.component").alias("main"), (-F.col("top.known.minus")).alias("lead"), "total")
        )
        open_ = self.scratch.store(rows.drop("fame").join(tokens, "token"), f"{name}-open")
        self.scratch.drop(f"{name}-rows")
        return open_

    def rounds(self) -> DataFrame:
        """Compare each group with the head that shares most of its prefix, until few pairs are left to compare."""
        labels, step = self.current("labels-0"), 0
        lead = self.like.select(F.col("head").alias("lead"), F.col("n").alias("m"), F.col("sketch").alias("of_lead"))
        limit = 1 - self.percent / 100 + 1e-9
        tried_before = None
        while True:
            open_ = self.open_tokens(labels, f"round-{step}")
            apart = open_.where("component <> main")
            left, heads = apart.agg(F.coalesce(F.sum("total"), F.lit(0)), F.countDistinct("head")).first()
            if left <= 4 * heads:
                break
            # What a group shares with all leads of a component bounds what it shares with one of its members.
            by_lead = hopeful(apart, self.percent).join(lead, "lead").join(self.like.select("head", "n", "sketch"), ["head", "n"])
            if tried_before is not None:  # these were not similar
                by_lead = by_lead.join(tried_before, (F.col("head") == F.col("_a")) & (F.col("lead") == F.col("_b")), "left_anti")
            near = least_distance(F.col("n"), F.col("m"), F.col("sketch"), F.col("of_lead"))
            best = F.max(F.struct((near <= limit).alias("fits"), "c", (-F.col("lead")).alias("minus")))
            pairs = (
                by_lead.groupBy("head", "n", "main")
                .agg(F.sum("c").alias("all"), best.alias("best"))
                .where(F.col("best.fits") & enough(F.col("n"), F.col("n"), F.col("all"), self.percent))
                .groupBy("head")
                .agg(F.max(F.struct("all", "best.minus")).alias("best"))
                .select(F.col("head").alias("a"), (-F.col("best.minus")).alias("b"))
            )
            found = self.compare(pairs)
            apart_now = found.where("NOT linked").select(F.col("a").alias("_a"), F.col("b").alias("_b"))
            tried_before = apart_now if tried_before is None else tried_before.unionByName(apart_now)
            tried, gained = found.agg(F.count(F.lit(1)), F.count_if("linked")).first()
            if not gained:
                break
            self.scratch.drop(f"round-{step}-open")
            labels, step = self.current(f"labels-{step + 1}"), step + 1
            if gained * LEAST_GAIN < tried:
                open_ = self.open_tokens(labels, f"round-{step}")
                break
        return open_

    def rest(self, open_: DataFrame) -> None:
        """Every pair of groups whose prefixes share enough, that fits in size and lies in different components."""
        # A pair shares no more shingles than either of its groups has here; that keeps hopeless pairs from being made.
        # So do the sketches: members lie within `reach` of their head, so heads that are further apart have no similar
        # members either.
        most = open_.groupBy("head").agg(F.countDistinct("token").alias("k"))
        open_ = self.scratch.store(open_.join(most, "head").join(self.like, ["head", "n"]), "open")
        self.scratch.drop("index-fame")
        limit = 1 - self.percent / 100 + 1e-9
        few = open_.where("component <> main").select(
            "token", F.col("head").alias("x"), F.col("n").alias("nx"), F.col("k").alias("kx"), F.col("component").alias("cx"),
            F.col("main").alias("mx"), F.col("sketch").alias("sx"), F.col("reach").alias("rx"),
        )
        all_ = open_.select(
            "token", F.col("head").alias("y"), F.col("n").alias("ny"), F.col("k").alias("ky"), F.col("component").alias("cy"),
            F.col("sketch").alias("sy"), F.col("reach").alias("ry"),
        )
        fits = enough(F.col("nx"), F.col("ny"), F.least("kx", "ky"), self.percent) & (F.col("cx") != F.col("cy"))
        near = least_distance(F.col("nx"), F.col("ny"), F.col("sx"), F.col("sy")) <= limit + F.col("rx") + F.col("ry")
        once = (F.col("cy") == F.col("mx")) | (F.col("x") < F.col("y"))
        pairs = (
            few.join(all_, "token")
            .where(fits & once & near)
            .groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.least("nx", "ny").alias("na"), F.greatest("nx", "ny").alias("nb"))
            .agg(F.count(F.lit(1)).alias("c"))
            .where(enough(F.col("na"), F.col("nb"), F.col("c"), self.percent))
            .select("a", "b")
            .distinct()
        )
        found = self.compare(pairs)
        self.scratch.drop("open")
        # Members lie within `reach` of their head; two of them are similar only if the heads are that near.
        reach = self.inside.where("node <> head").groupBy("head").agg(F.max("reach").alias("reach"))
        side = lambda c: reach.select(F.col("head").alias(c), F.col("reach").alias(f"r{c}"))
        near = (
            found.where("NOT linked")
            .join(side("a"), "a", "left")
            .join(side("b"), "b", "left")
            .na.fill(0.0, ["ra", "rb"])
            .where((F.col("ra") + F.col("rb") > 0) & (F.col("distance") <= limit + F.col("ra") + F.col("rb")))
            .select("a", "b", "distance")
        )
        group = self.inside.where("node <> head").select("head", "node", "reach")
        group = group.unionByName(group.select("head", F.col("head").alias("node"), F.lit(0.0).alias("reach")).distinct())
        alone = lambda c: near.select(F.col(c).alias("head"), F.col(c).alias("node"), F.lit(0.0).alias("reach")).distinct()
        group = group.unionByName(alone("a")).unionByName(alone("b")).distinct()
        own = self.nodes.select("node", "n", "sketch")
        x = group.join(own, "node").select(F.col("head").alias("a"), F.col("node").alias("x"), F.col("reach").alias("rx"), F.col("n").alias("nx"), F.col("sketch").alias("sx"))
        y = group.join(own, "node").select(F.col("head").alias("b"), F.col("node").alias("y"), F.col("reach").alias("ry"), F.col("n").alias("ny"), F.col("sketch").alias("sy"))
        fits = (F.col("rx") + F.col("ry") > 0) & (F.col("distance") <= limit + F.col("rx") + F.col("ry"))
        pairs = near.join(x, "a").join(y, "b").where(fits & (least_distance(F.col("nx"), F.col("ny"), F.col("sx"), F.col("sy")) <= limit))
        self.compare(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        self.scratch.drop("texts")

    def run(self) -> DataFrame:
        self.prepare()
        self.members()
        self.rest(self.rounds())
        labels = self.current("labels")
        named = self.rows.where("doc_id IS NOT NULL AND n > 0").join(self.nodes.select("sig", "node"), "sig")
        linked = named.join(labels, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))
        apart = self.rows.where("doc_id IS NULL OR n = 0")
        return linked.unionByName(apart.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).alias("component_id")))


def link(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row."""
    return Join(docs, id_col, text_col, words, percent).run()


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The document of smallest id of each component, with the columns of `docs` as they are."""
    join = Join(docs, id_col, text_col, words, percent)
    stay = join.run().where("component_id IS NULL OR doc_id = component_id").select(F.col("doc_id").alias("_stays")).distinct()
    stay = common.Scratch(docs.sparkSession, "ngram-kept").store(stay, "stay")
    join.scratch.drop()
    return docs.join(stay, docs[id_col].cast("bigint").eqNullSafe(F.col("_stays")), "left_semi")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
  l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 90 * (x.n + y.n - i)),
  e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
  r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(min(c), w.doc_id) AS component_id FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY w.doc_id, n.n
"""
