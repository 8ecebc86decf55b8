"""Scores of texts under a Katz backoff model that is learnt from the training part of the same table.

The model is of order two. The chance of a word after a context is its discounted relative count if the pair was seen
in training, else the context's backoff weight times the word's own chance; that is the discounted relative count of
a known word, else what discounting has left over for unknown words. Counts up to `K` are discounted by Good-Turing.
Backoff weights are (1 - sum of discounted chances of what was seen) / (1 - sum of the own chances of what was seen),
so every distribution adds up to 1 exactly. A text is scored from its beginning (a context of its own) to its end.

Work is done on blocks of documents and exchanged as packed arrays, so a row of a shuffle stands for many counts:

1. Blocks: texts become codes of a block's own vocabulary. The vocabulary goes to buckets by hash, with counts.
2. Buckets add up the counts. Words are numbered by falling count, so that a number tells the count by a table of
   the distinct counts (at most sqrt(2 N) of them), and numbers are returned to the blocks.
3. Blocks deal the pairs of their texts to buckets by context, with counts and the documents they stand in. Contexts
   that hold more than their part of all tokens are dealt by pair instead; there are few such, by definition.
4. Buckets keep the pairs with their counts (the model's table), then score them and send a sum per document back.

Words are told apart by a 64-bit hash. Tables are rows by bucket in the run's scratch folder.

Pairs are packed from two numbers of 32 bits; a corpus with more distinct words than that ends with an error.

Defined results: a NULL text is empty and scores its end. A NULL id counts as the empty name and trains. Repeated rows
count each. Without training text every count is 0 and every token is unknown. Other columns are not read.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

K = 5
#: Tokens of a block; with the number of buckets (two for each part of a shuffle) it decides what a worker holds.
BLOCK = 1_000_000
END_HASH = np.uint64(xxhash.xxh64_intdigest(b""))
BITS = 32
LOW = (1 << BITS) - 1


def pack(a: np.ndarray) -> bytes:
    """Numbers in bytes: by planes of equal significance, compressed."""
    a = np.ascontiguousarray(a)
    return zstandard.compress(a.dtype.char.encode() + a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes(), 1)


def unpack(b: bytes) -> np.ndarray:
    raw = zstandard.decompress(b)
    kind = np.dtype(raw[:1].decode())
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8, offset=1).reshape(kind.itemsize, -1).T).view(kind).ravel()


def small(a: np.ndarray) -> np.ndarray:
    """Non-negative numbers in the narrowest type."""
    top = int(a.max()) if len(a) else 0
    return a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.int64)


def steps(a: np.ndarray) -> np.ndarray:
    """Rising numbers as differences."""
    return np.diff(a, prepend=a.dtype.type(0))


# 1. Blocks


def _blocks(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        lengths: list[int] = []
        hashed: list[np.ndarray] = []
        task, serial, held = TaskContext.get().partitionId(), 0, 0

        def flushed() -> pa.RecordBatch:
            tokens = np.concatenate(hashed) if hashed else np.zeros(0, np.uint64)
            length = np.array(lengths, np.int64)
            train = np.array([zlib.crc32(b"" if i is None else str(i).encode()) % 5 != 1 for i in ids], bool)
            # The end of each document is a token of the vocabulary too.
            words, code, n = np.unique(tokens, return_inverse=True, return_counts=True)
            counts = np.bincount(code, np.repeat(train, length), minlength=len(words)).astype(np.int64)
            rank = np.empty(len(words), np.int64)
            rank[np.argsort(-n, kind="stable")] = np.arange(len(words))
            words = np.append(words, END_HASH)
            counts, rank = np.append(counts, train.sum()), np.append(rank, len(rank))
            order = np.argsort(words)
            words, counts, rank = words[order], counts[order], rank[order]
            bucket = (words % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
            block = (task << 24) + serial
            out = {"block": [block], "bucket": [-1], "a": [pack(small(_coded(rank, order, code)))], "b": [pack(small(length))], "c": [pack(train)], "ids": [list(ids)]}
            for k in range(buckets):
                at = by[cuts[k] : cuts[k + 1]]
                if len(at):
                    for name, value in zip(out, (block, k, pack(steps(words[at])), pack(small(counts[at])), pack(small(rank[at])), None), strict=True):
                        out[name].append(value)
            ids.clear(), lengths.clear(), hashed.clear()
            return next(common.rows_of([out], BLOCK_SCHEMA))

        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                codes, vocabulary, ends = common.word_codes([t.lower().split() for t in texts])
                by_code = np.array([xxhash.xxh64_intdigest(w) for w in vocabulary.to_pylist()], np.uint64)
                hashed.append(by_code[codes] if len(codes) else np.zeros(0, np.uint64))
                lengths += np.diff(ends, prepend=0).tolist()
                ids += part.column(0).to_pylist()
                held += len(codes) + len(texts)
                if held >= BLOCK:
                    yield flushed()
                    serial, held = serial + 1, 0
        if ids:
            yield flushed()

    return run


def _coded(rank: np.ndarray, order: np.ndarray, code: np.ndarray) -> np.ndarray:
    """Codes by falling frequency: `rank` stands in the order of `order`, `code` in the order before it."""
    before = np.empty(len(rank), np.int64)
    before[order] = rank
    return before[code]


BLOCK_SCHEMA = pa.schema([("block", pa.int64()), ("bucket", pa.int32()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("ids", pa.list_(pa.int64()))])
BLOCK_KIND = "block bigint, bucket int, a binary, b binary, c binary, ids array<bigint>"


# 2. Vocabulary


def _totals(rows: pd.DataFrame) -> pd.DataFrame:
    words = np.concatenate([np.cumsum(unpack(x), dtype=np.uint64) for x in rows["a"]])
    counts = np.concatenate([unpack(x).astype(np.int64) for x in rows["b"]])
    words, at = np.unique(words, return_inverse=True)
    counts = np.bincount(at, counts, minlength=len(words)).astype(np.int64)
    words, counts = words[counts > 0], counts[counts > 0]
    values, n = np.unique(counts, return_counts=True)
    return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "words": [pack(steps(words))], "counts": [pack(small(counts))], "values": [values.tolist()], "n": [n.tolist()]})

#: Words that numbers of 32 bits tell apart, 0 being unknown words.
MOST_WORDS = (1 << 32) - 1


class Counts:
    """Own chances of words by number: words are numbered from 1 by falling count, 0 is an unknown word."""

    def __init__(self, number_of: dict[int, int]):
        self.value = np.array(sorted(number_of, reverse=True), np.int64)
        size = np.array([number_of[int(v)] for v in self.value], np.int64)
        self.ends = np.cumsum(size)
        self.first = dict(zip(self.value.tolist(), (self.ends - size + 1).tolist(), strict=True))
        self.tokens, self.types = int((self.value * size).sum()), int(size.sum())
        if self.types >= MOST_WORDS:
            raise ValueError(f"{self.types} distinct words; pairs are packed from numbers of 32 bits")
        d = discounts([number_of.get(r, 0) for r in range(1, K + 2)])
        chance = discounted(self.value, d) / max(1, self.tokens)
        left = 1 - float((chance * size).sum())
        if left < 1 / (self.tokens + 1):  # no count was discounted: one more token, unknown
            chance, left = chance * (self.tokens / (self.tokens + 1)), 1 - float((chance * size).sum()) * self.tokens / (self.tokens + 1)
        self.chance, self.unknown = chance, left

    def count(self, number: np.ndarray) -> np.ndarray:
        if not len(self.value):
            return np.zeros(len(number), np.int64)
        return np.where(number > 0, self.value[np.searchsorted(self.ends, np.maximum(number, 1))], 0)

    def own(self, number: np.ndarray) -> np.ndarray:
        if not len(self.value):
            return np.full(len(number), self.unknown)
        return np.where(number > 0, self.chance[np.searchsorted(self.ends, np.maximum(number, 1))], self.unknown)


def discounts(n: list[int]) -> np.ndarray:
    """Good-Turing factors for counts 1..K from the numbers of things seen 1..K+1 times; index 0 is not used.

    The largest range of counts for which the factors make sense is discounted; if there is none, a constant is
    taken off each count, as much as ones and twos suggest.
    """
    d = np.ones(K + 1)
    for k in range(K, 0, -1):
        if all(n[: k + 1]):
            common_ = (k + 1) * n[k] / n[0]
            trial = [((r + 1) * n[r] / (r * n[r - 1]) - common_) / (1 - common_) for r in range(1, k + 1)] if common_ != 1 else [0]
            if all(0 < x <= 1 for x in trial):
                d[1 : k + 1] = trial
                return d
    off = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
    d[1:] = [(r - off) / r for r in range(1, K + 1)]
    return d


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.where(counts <= K, d[np.minimum(counts, K)], 1.0) * counts


def _numbers(first: dict[int, int]):
    def run(key: tuple, asked: pd.DataFrame, total: pd.DataFrame) -> pd.DataFrame:
        row = total.iloc[0]
        words, counts = np.cumsum(unpack(row["words"]), dtype=np.uint64), unpack(row["counts"]).astype(np.int64)
        offset = dict(zip(row["values"], row["offsets"], strict=True))
        order = np.argsort(counts, kind="stable")
        values, start = np.unique(counts[order], return_index=True)
        base = np.array([first[int(v)] + offset[int(v)] for v in values], np.int64)
        at = np.searchsorted(values, counts)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        number = base[at] + place - start[at] if len(words) else np.zeros(0, np.int64)
        out = []
        for block, a in zip(asked["block"], asked["a"], strict=True):
            mine = np.cumsum(unpack(a), dtype=np.uint64)
            i = np.minimum(np.searchsorted(words, mine), max(0, len(words) - 1))
            found = np.where(words[i] == mine, number[i], 0) if len(words) else np.zeros(len(mine), np.int64)
            out.append((block, key[0], pack(small(found))))
        return pd.DataFrame(out, columns=["block", "bucket", "numbers"])

    return run


# 3. Pairs


def _pairs(counts: Counts, buckets: int, end: int, hot: int):
    begin = counts.types + 1

    def run(key: tuple, docs: pd.DataFrame, vocabulary: pd.DataFrame, answers: pd.DataFrame) -> Iterator[tuple]:
        doc = docs.iloc[0]
        rank = {b: unpack(c).astype(np.int64) for b, c in zip(vocabulary["bucket"], vocabulary["c"], strict=True)}
        number = np.zeros(sum(map(len, rank.values())), np.int64)
        for b, packed in zip(answers["bucket"], answers["numbers"], strict=True):
            number[rank[b]] = unpack(packed)
        words, length, train = number[unpack(doc["a"]).astype(np.int64)], unpack(doc["b"]).astype(np.int64), unpack(doc["c"]).astype(bool)
        n = len(length)
        ends = np.cumsum(length)
        token = np.insert(words, ends, end)
        last = ends + np.arange(n)
        first = last - length
        context = np.empty_like(token)
        context[1:] = token[:-1]
        context[first] = begin
        owner = np.repeat(np.arange(n), length + 1)
        seen = counts.count(token)
        base = np.bincount(owner, np.log10((seen + 0.5) / (counts.tokens + 0.5 * (counts.types + 1))), minlength=n)
        alone = context == 0
        local = np.bincount(owner[alone], np.log10(counts.own(token[alone])), minlength=n).astype(float)
        known = np.bincount(owner, seen > 0, minlength=n).astype(np.int64)
        yield -1 - key[0], key[0], pickled(doc["ids"], ~train, length + 1, known, base, local), None, None, None
        pair, owner = (context[~alone] << BITS) | token[~alone], owner[~alone]
        at = np.argsort(pair, kind="stable")
        pair, owner = pair[at], owner[at]
        start = np.flatnonzero(np.diff(pair, prepend=-1))
        times = np.diff(start, append=len(pair))
        taught = np.add.reduceat(train[owner].astype(np.int64), start) if len(pair) else times
        pair = pair[start]
        spread = np.where(((pair >> BITS) <= hot) | ((pair >> BITS) == begin), pair, pair >> BITS)
        bucket = (common.mixed(spread.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")
        cuts = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for k in range(buckets):
            mine = by[cuts[k] : cuts[k + 1]]
            if len(mine):
                inside = np.repeat(start[mine] - np.cumsum(times[mine]) + times[mine], times[mine]) + np.arange(times[mine].sum())
                yield k, key[0], pack(steps(pair[mine])), pack(small(taught[mine])), pack(small(times[mine])), pack(small(owner[inside]))

    return run


def pickled(ids, held, tokens, known, base, local) -> bytes:
    return zstandard.compress(pickle.dumps((np.array(ids, object), held, tokens, known, base, local)), 1)


def _dealt(counts: Counts, buckets: int, end: int, hot: int):
    pairs = _pairs(counts, buckets, end, hot)

    def run(key: tuple, block: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        rows = pairs(key, block[block["bucket"] == -1], block[block["bucket"] >= 0], answers)
        return pd.DataFrame(rows, columns=["bucket", "block", "a", "taught", "times", "owner"])

    return run


PAIRS = "bucket bigint, block bigint, a binary, taught binary, times binary, owner binary"
#: The model's table and what is to be scored with it: pairs and counts of a bucket, then by block places and owners.
SHELF = "bucket bigint, pairs binary, counts binary, numbers array<bigint>, hot binary, blocks array<bigint>, places array<binary>, times array<binary>, owners array<binary>, docs binary"


def _context_sums(pairs: np.ndarray, counts: np.ndarray, own: Counts) -> tuple[np.ndarray, np.ndarray]:
    """Contexts, and for each: total count, number of pairs seen 1..K times, sum of larger counts, own chances."""
    seen = counts > 0
    pairs, counts = pairs[seen], counts[seen]
    context, at = np.unique(pairs >> BITS, return_inverse=True)
    columns = [np.bincount(at, counts, minlength=len(context))]
    columns += [np.bincount(at, counts == r, minlength=len(context)) for r in range(1, K + 1)]
    columns += [np.bincount(at, np.where(counts > K, counts, 0), minlength=len(context)), np.bincount(at, own.own(pairs & LOW), minlength=len(context))]
    return context, np.stack(columns, axis=1).astype(float)


def _shelved(own: Counts, hot: int):
    begin = own.types + 1

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        empty = {"bucket": bucket, "pairs": None, "counts": None, "numbers": None, "hot": None, "blocks": [], "places": [], "times": [], "owners": [], "docs": None}
        if bucket < 0:
            return pd.DataFrame([{**empty, "blocks": [int(rows["block"].iloc[0])], "docs": rows["a"].iloc[0]}])
        each = [np.cumsum(unpack(a), dtype=np.int64) for a in rows["a"]]
        pairs, at = np.unique(np.concatenate(each), return_inverse=True)
        counts = np.bincount(at, np.concatenate([unpack(t).astype(np.int64) for t in rows["taught"]]), minlength=len(pairs)).astype(np.int64)
        numbers = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[: K + 2]
        context = pairs >> BITS
        heavy = (context <= hot) | (context == begin)
        names, sums = _context_sums(pairs[heavy], counts[heavy], own)
        places, start = [], 0
        for e in each:
            places.append(pack(small(steps(at[start : start + len(e)]))))
            start += len(e)
        return pd.DataFrame([{
            **empty, "pairs": pack(steps(pairs)), "counts": pack(small(counts)), "numbers": numbers.tolist(), "hot": pack(np.column_stack([names, sums]).ravel()) if len(names) else None,
            "blocks": rows["block"].tolist(), "places": places, "times": rows["times"].tolist(), "owners": rows["owner"].tolist(),
        }])

    return run


# 4. Scores


def weights(sums: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(divisor of discounted counts, backoff weight) of contexts from their sums."""
    total = sums[:, 0]
    seen = (sums[:, 1 : K + 1] * (d[1:] * np.arange(1, K + 1))).sum(axis=1) + sums[:, K + 1]
    divisor = np.where(total - seen < 1e-9 * total, total + 1, total)  # nothing was discounted: one more, unseen
    return divisor, (1 - seen / divisor) / np.maximum(1 - sums[:, K + 2], 1e-300)


def _scored(own: Counts, d: np.ndarray, hot: dict[int, np.ndarray]):
    hot_names = np.array(sorted(hot), np.int64)
    hot_sums = np.array([hot[int(v)] for v in hot_names]).reshape(-1, K + 3)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(len(batch)):
                row = {n: c[r].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}
                pairs, counts = np.cumsum(unpack(row["pairs"]), dtype=np.int64), unpack(row["counts"]).astype(np.int64)
                names, sums = _context_sums(pairs, counts, own)
                context = pairs >> BITS
                divisor, back = np.ones(len(pairs)), np.ones(len(pairs))  # a context that was never seen backs off whole
                for known, table in ((names, sums), (hot_names, hot_sums)):
                    if len(known):
                        i = np.minimum(np.searchsorted(known, context), len(known) - 1)
                        hit = known[i] == context
                        div, alpha = weights(table, d)
                        divisor[hit], back[hit] = div[i[hit]], alpha[i[hit]]
                chance = np.where(counts > 0, discounted(counts, d) / divisor, back * own.own(pairs & LOW))
                log = np.log10(chance)
                out = {"block": [], "sums": []}
                for block, places, times, owners in zip(row["blocks"], row["places"], row["times"], row["owners"], strict=True):
                    at = np.cumsum(unpack(places), dtype=np.int64)
                    part = np.bincount(unpack(owners), np.repeat(log[at], unpack(times).astype(np.int64)))
                    out["block"].append(block)
                    out["sums"].append(pack(part))
                yield next(common.rows_of([out], pa.schema([("block", pa.int64()), ("sums", pa.binary())])))

    return run


def _finished(train_tokens: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        docs = rows[rows["docs"].notna()].iloc[0]["docs"]
        ids, held, tokens, known, base, local = pickle.loads(zstandard.decompress(docs))
        score = local.copy()
        for packed in rows["sums"].dropna():
            part = unpack(packed)
            score[: len(part)] += part
        return pd.DataFrame({
            "doc_id": pd.array(ids, "Int64"), "held_out": held, "n_tokens": tokens, "n_known": known, "train_tokens": train_tokens, "base_score": base, "score": score,
        })

    return run


RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_documents(docs: DataFrame) -> DataFrame:
    """RESULT rows; documents whose crc32 of the id, as text, leaves 1 by 5 are held out of training."""
    spark = docs.sparkSession
    scratch, buckets = common.Scratch(spark, "katz"), 2 * common.slices(spark)
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocks = scratch.store(plain.mapInArrow(_blocks(buckets), BLOCK_KIND), "blocks")
    asked = blocks.where("bucket >= 0")
    kind = "bucket int, words binary, counts binary, values array<bigint>, n array<bigint>"
    totals = scratch.store(asked.select("bucket", "a", "b").groupBy("bucket").applyInPandas(_totals, kind), "unigrams")
    each = totals.select("bucket", F.explode(F.arrays_zip("values", "n")).alias("x")).select("bucket", "x.values", "x.n")
    own = Counts({r["values"]: r["n"] for r in each.groupBy("values").agg(F.sum("n").alias("n")).collect()})
    earlier = Window.partitionBy("values").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        each.withColumn("offset", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        .groupBy("bucket")
        .agg(F.sort_array(F.collect_list(F.struct("values", "offset"))).alias("o"))
        .select("bucket", F.col("o.offset").alias("offsets"))
    )
    numbered = totals.join(offsets, "bucket", "left").select("bucket", "words", "counts", "values", F.coalesce("offsets", F.array().cast("array<bigint>")).alias("offsets"))
    answers = asked.select("block", "bucket", "a").groupBy("bucket").cogroup(numbered.groupBy("bucket")).applyInPandas(_numbers(own.first), "block bigint, bucket int, numbers binary")
    answers = scratch.store(answers, "numbers")
    # The number of the end, found as any word's.
    end_bucket = int(END_HASH % np.uint64(buckets))
    end = _end_number(blocks, answers, end_bucket)
    share = max(1, own.tokens // buckets)
    hot = int(own.ends[int((own.value > share).sum()) - 1]) if (own.value > share).any() else 0
    needed = blocks.select("block", "bucket", F.when(F.col("bucket") < 0, F.col("a")).alias("a"), F.when(F.col("bucket") < 0, F.col("b")).alias("b"), "c", "ids")
    dealt = needed.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_dealt(own, buckets, end, hot), PAIRS)
    shelf = scratch.store(dealt.groupBy("bucket").applyInPandas(_shelved(own, hot), SHELF), "bigrams")
    pairs = shelf.where("bucket >= 0")
    n = pairs.select(*[F.col("numbers")[r].alias(f"n{r}") for r in range(1, K + 2)]).agg(*[F.coalesce(F.sum(f"n{r}"), F.lit(0)) for r in range(1, K + 2)]).first()
    d = discounts(list(n))
    sums: dict[int, np.ndarray] = {}
    # At most as many contexts as there are buckets, and the beginning, in each bucket.
    for r in pairs.where("hot IS NOT NULL").select("hot").mapInArrow(_hot_rows, f"context bigint, {', '.join(f's{i} double' for i in range(K + 3))}").groupBy("context").agg(*[F.sum(f"s{i}").alias(f"s{i}") for i in range(K + 3)]).collect():
        sums[r["context"]] = np.array(list(r)[1:])
    parts = pairs.select("pairs", "counts", "blocks", "places", "times", "owners").mapInArrow(_scored(own, d, sums), "block bigint, sums binary")
    none = F.lit(None).cast("binary")
    ends = shelf.where("bucket < 0").select(F.col("blocks")[0].alias("block"), none.alias("sums"), "docs")
    return parts.withColumn("docs", none).unionByName(ends).groupBy("block").applyInPandas(_finished(own.tokens), RESULT)


def _hot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["context", *(f"s{i}" for i in range(K + 3))]
    for batch in batches:
        for packed in batch.column(0).to_pylist():
            table = unpack(packed).reshape(-1, K + 4)
            yield pa.RecordBatch.from_arrays([pa.array(table[:, 0].astype(np.int64)), *(pa.array(table[:, i]) for i in range(1, K + 4))], names=names)


def _end_number(blocks: DataFrame, answers: DataFrame, bucket: int) -> int:
    """Any block has asked for the end; 0 if no document trains."""
    asked = blocks.where(F.col("bucket") == bucket).select("block", "a").limit(1).collect()
    if not asked:
        return 0
    words = np.cumsum(unpack(bytes(asked[0]["a"])), dtype=np.uint64)
    got = answers.where((F.col("bucket") == bucket) & (F.col("block") == asked[0]["block"])).select("numbers").first()
    return int(unpack(bytes(got["numbers"]))[int(np.searchsorted(words, END_HASH))])


def op3_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(common.table(spark, sf_dir, "documents"))
