"""Phrases whose words occur together more often than apart, counted in quotient filters.

1. Texts are cut into pieces and words and gathered by language into segments, in which a word is a small number.
2. Words with enough occurrences get a number over all segments, 1 to V. A phrase with enough occurrences has no other
   word, so other words end a phrase, like the edge of a piece. Words of two languages are two words.
3. The numbers of an n-gram are packed into one integer and permuted by a bijection (each part takes the exclusive or
   with a hash of the other parts, so it can be undone). The leading bits are the quotient, all others the remainder:
   nothing is lost. A filter holds the remainders of the n-grams by quotient, the length of each quotient's run in
   unary, and counters of one byte, longer where needed.
4. Filters are sorted by the permuted number, so filters of one range of quotients are merged in order. As the numbers are
   permuted, ranges are even: a frequent n-gram is one slot in each filter whatever its count. With many ranges the
   filters are dealt in two steps, so that messages do not grow with the square of the input.
5. Frequent n-grams are numbers again by the inverse permutation. Scores, parts and containing phrases are joins.

Counts and scores are exact while counts have at most 16 digits; beyond, the run ends with an error.

Defined results: a NULL or empty text has no words. A NULL language is `und`. Repeated rows count as often as they
occur. A language without words has no rows. Ids and other columns are not read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of text that a task gathers before it writes segments; a longer text is a segment of its own.
SEGMENT_BYTES = 8 << 20
#: n-grams counted at once.
CHUNK = 1 << 20
#: Slots that reach the merge of one range at most, on average.
SLOTS = 1 << 21
#: Ranges (as bits) beyond which filters are dealt in two steps.
FAN_BITS = 10
ROUNDS = 2
ESCAPE = 255

EDGES = b".,;:!?\n\x0b\x0c\r"
UPPER = bytes(range(65, 91))
#: Lower case, tabs as spaces, edges of pieces as line feeds.
PLAIN = bytes.maketrans(UPPER + b"\t" + EDGES, UPPER.lower() + b" " + b"\n" * len(EDGES))


@dataclass(frozen=True)
class Limits:
    """Parameters: longest phrase, least occurrences, share of a phrase within a longer one that drops it, phrases per language."""

    words: int = 3
    occurrences: int = 10
    contained_percent: int = 50
    first: int = 2000


# --- permuted numbers ------------------------------------------------------------------------------------------------


def _other(lanes: list[np.ndarray], i: int, bits: int) -> np.ndarray:
    h = np.full(len(lanes[0]), i + 1, np.uint64)
    for j, lane in enumerate(lanes):
        if j != i:
            h = common.mixed(h ^ lane)
    return h >> np.uint64(64 - bits)


def permuted(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """A bijection of tuples of `bits`-bit numbers."""
    lanes = [x.astype(np.uint64) for x in lanes]
    for _ in range(ROUNDS):
        for i in range(len(lanes)):
            lanes[i] = lanes[i] ^ _other(lanes, i, bits)
    return lanes


def restored(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    lanes = list(lanes)
    for _ in range(ROUNDS):
        for i in reversed(range(len(lanes))):
            lanes[i] = lanes[i] ^ _other(lanes, i, bits)
    return lanes


def packed(lanes: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """One column of 64-bit numbers if all lanes fit, else a column per lane; ordered like the lanes."""
    if len(lanes) * bits > 64:
        return lanes
    key = lanes[0]
    for x in lanes[1:]:
        key = key << np.uint64(bits) | x
    return [key]


def unpacked(columns: list[np.ndarray], length: int, bits: int) -> list[np.ndarray]:
    if len(columns) == length:
        return columns
    mask = np.uint64((1 << bits) - 1)
    return [columns[0] >> np.uint64(bits * (length - 1 - i)) & mask for i in range(length)]


def summed(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and their counts. Sorted runs behind each other are merged."""
    if not len(counts):
        return columns, counts
    order = np.argsort(columns[0], kind="stable") if len(columns) == 1 else np.lexsort(columns[::-1])
    columns = [c[order] for c in columns]
    new = np.zeros(len(counts), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    first = np.flatnonzero(new)
    return [c[first] for c in columns], np.add.reduceat(counts[order], first)


def counted(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct keys and how often each occurs."""
    if len(columns) > 1:
        return summed(columns, np.ones(len(columns[0]), np.int64))
    keys = np.sort(columns[0])
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first]], np.diff(np.append(first, len(keys)))


# --- filters ---------------------------------------------------------------------------------------------------------


def _bits_of(values: np.ndarray, width: int) -> bytes:
    """Numbers of `width` bits behind each other."""
    out, size = [], -(-width // 8)
    for s in range(0, len(values), 1 << 17):  # a multiple of 8 numbers ends with a byte
        low = values[s : s + (1 << 17)].astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - size :]
        bits = np.unpackbits(low, axis=1)
        out.append(np.packbits(bits[:, 8 * size - width :]).tobytes())
    return b"".join(out)


def _numbers_of(data: memoryview, n: int, width: int) -> np.ndarray:
    if width <= 57:  # a number and what stands before it in its first byte fit 64 bits
        held = np.frombuffer(bytes(data[: -(-n * width // 8)]) + bytes(8), np.uint8)
        at = np.arange(n) * width
        windows = np.ndarray(len(held) - 7, ">u8", held, strides=(1,))
        shift = (64 - width - (at & 7)).astype(np.uint64)
        return windows[at >> 3].astype(np.uint64) >> shift & np.uint64((1 << width) - 1)
    out = []
    for s in range(0, n, 1 << 17):
        k = min(n - s, 1 << 17)
        raw = np.frombuffer(data, np.uint8, -(-k * width // 8), s * width // 8)
        bits = np.zeros((k, 64), np.uint8)
        bits[:, 64 - width :] = np.unpackbits(raw, count=k * width).reshape(k, width)
        out.append(np.packbits(bits, axis=1).view(">u8").ravel())
    return np.concatenate(out or [np.zeros(0, ">u8")]).astype(np.uint64)


def _lead(length: int, bits: int) -> tuple[int, list[int]]:
    """Width of the first column and of the others."""
    return (length * bits, []) if length * bits <= 64 else (bits, [bits] * (length - 1))


def encoded(columns: list[np.ndarray], counts: np.ndarray, length: int, bits: int, known: int) -> bytes:
    """A filter of sorted keys that agree in their first `known` bits, which are left out."""
    width, others = _lead(length, bits)
    n, width = len(counts), width - known
    quotient_bits = min(width, max(0, n.bit_length() - 1))
    lead = columns[0] & np.uint64((1 << width) - 1)
    rest = width - quotient_bits
    runs = np.zeros(n + (1 << quotient_bits), np.uint8)
    quotient = (lead >> np.uint64(rest)).astype(np.int64) if quotient_bits else np.zeros(n, np.int64)
    runs[np.arange(n) + quotient] = 1
    high = counts[counts >= ESCAPE]
    body = [np.packbits(runs).tobytes(), _bits_of(lead & np.uint64((1 << rest) - 1), rest) if rest else b""]
    body += [_bits_of(c, w) for c, w in zip(columns[1:], others, strict=True)]
    body += [np.minimum(counts, ESCAPE).astype(np.uint8).tobytes(), high.astype("<i8").tobytes()]
    return struct.pack("<qqq", n, quotient_bits, len(high)) + b"".join(body)


def decoded(data: bytes, length: int, bits: int, known: int, range_: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys and counts of a filter of range `range_`."""
    width, others = _lead(length, bits)
    width -= known
    n, quotient_bits, n_high = struct.unpack_from("<qqq", data)
    view, at = memoryview(data), 24
    rest = width - quotient_bits
    runs = np.unpackbits(np.frombuffer(view, np.uint8, -(-(n + (1 << quotient_bits)) // 8), at), count=n + (1 << quotient_bits))
    at += -(-(n + (1 << quotient_bits)) // 8)
    quotient = np.flatnonzero(runs) - np.arange(n)
    lead = np.uint64(range_) << np.uint64(width) if known else np.uint64(0)
    first = np.full(n, lead) | (quotient.astype(np.uint64) << np.uint64(rest) if quotient_bits else np.uint64(0))
    if rest:
        first |= _numbers_of(view[at:], n, rest)
        at += -(-n * rest // 8)
    columns = [first]
    for w in others:
        columns.append(_numbers_of(view[at:], n, w))
        at += -(-n * w // 8)
    counts = np.frombuffer(view, np.uint8, n, at).astype(np.int64)
    counts[counts == ESCAPE] = np.frombuffer(view, "<i8", n_high, at + n)
    return columns, counts


def _cut(columns: list[np.ndarray], counts: np.ndarray, length: int, bits: int, known: int) -> Iterator[tuple[int, int, bytes]]:
    """(range, slots, filter) of each range that sorted keys reach."""
    width, _ = _lead(length, bits)
    ranges = (columns[0] >> np.uint64(width - known)).astype(np.int64) if known else np.zeros(len(counts), np.int64)
    starts = np.flatnonzero(np.diff(ranges, prepend=-1))
    for s, e in zip(starts.tolist(), np.append(starts, len(ranges))[1:].tolist(), strict=True):
        yield int(ranges[s]), e - s, encoded([c[s:e] for c in columns], counts[s:e], length, bits, known)


# --- texts to filters ------------------------------------------------------------------------------------------------


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the texts of one task: words with their occurrences, and all words by place, -1 at the edges of pieces."""
    segment, held, size = TaskContext.get().partitionId() << 32, {}, 0

    def written() -> Iterator[pa.RecordBatch]:
        nonlocal segment
        for lang, texts in held.items():
            flat = pa.array([b" \n ".join(texts).replace(b"\n", b" \n ")], pa.large_binary())
            coded = pa.compute.split_pattern(flat, pattern=b" ").flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            number = np.cumsum([w not in (b"", b"\n") for w in words]) - 1
            number[[i for i, w in enumerate(words) if w == b"\n"]] = -1
            number[[i for i, w in enumerate(words) if w == b""]] = -2
            codes = number[np.asarray(coded.indices)]
            codes = codes[codes > -2]
            words = [w.decode() for w in words if w not in (b"", b"\n")]
            times = np.bincount(codes[codes >= 0], minlength=len(words))
            stored = codes.astype(np.uint16 if len(words) < 65535 else np.uint32).tobytes()  # -1 is the largest number
            columns = [pa.array([words], pa.list_(pa.string())), pa.array([times], pa.list_(pa.int64())), pa.array([stored], pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([lang]), *columns], names=["segment", "lang", "words", "times", "codes"])
            segment += 1
        held.clear()

    for batch in batches:
        for part, texts in common.parts(batch, "text", SEGMENT_BYTES // 4):
            for lang, text in zip(part.column(1).to_pylist(), texts, strict=True):
                held.setdefault(lang, []).append(text.translate(PLAIN))
                size += len(text)
                if size >= SEGMENT_BYTES:
                    yield from written()
                    size = 0
    yield from written()


def _fragments(words: int, bits: int, known: int):
    """Filters of one segment, by phrase length and range."""

    def run(key: tuple, segments: pa.Table, numbers: pa.Table) -> pa.Table:
        out = []
        for segment, n_words, codes in zip(*(segments.column(c).to_pylist() for c in ("of", "n_words", "codes")), strict=True):
            codes = np.frombuffer(codes, np.uint16 if n_words < 65535 else np.uint32)
            number = np.zeros(n_words + 1, np.int64)  # edges of pieces take the last place, which stays 0
            number[np.asarray(numbers.column("place"))] = np.asarray(numbers.column("id"))
            ids = number[np.minimum(codes, n_words)]
            for length in range(2, words + 1):
                for s in range(0, len(ids) - length + 1, CHUNK):
                    window = [ids[s + i : min(s + i + CHUNK, len(ids) - length + 1 + i)] for i in range(length)]
                    alive = np.all([w > 0 for w in window], axis=0)
                    keys = packed(permuted([w[alive] for w in window], bits), bits)
                    keys, counts = counted(keys)
                    out += [(segment, length, *x) for x in _cut(keys, counts, length, bits, known)]
        columns = list(zip(*out, strict=True)) or [()] * 5
        return pa.table([pa.array(c, f.type) for c, f in zip(columns, FRAGMENT, strict=True)], schema=FRAGMENT)

    return run


FRAGMENT = pa.schema([("segment", pa.int64()), ("length", pa.int32()), ("range", pa.int64()), ("slots", pa.int64()), ("filter", pa.binary())])
FRAGMENT_DDL = "segment bigint, length int, `range` bigint, slots bigint, filter binary"


def _merged(table: pa.Table, bits: int, known: int) -> tuple[int, list[np.ndarray], np.ndarray]:
    length, range_ = table.column("length")[0].as_py(), table.column("range")[0].as_py()
    parts = [decoded(x.as_buffer(), length, bits, known, range_) for x in table.column("filter")]
    columns = [np.concatenate(c) for c in zip(*(p[0] for p in parts), strict=True)]
    return length, *summed(columns, np.concatenate([p[1] for p in parts]))


def _dealt_on(bits: int, known: int, finer: int):
    """Merge filters of a range and cut the result into finer ranges."""

    def run(table: pa.Table) -> pa.Table:
        length, columns, counts = _merged(table, bits, known)
        segment = table.column("segment")[0].as_py()
        rows = [(segment, length, *x) for x in _cut(columns, counts, length, bits, finer)]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FRAGMENT, strict=True)], schema=FRAGMENT)

    return run


def _finished(bits: int, known: int, occurrences: int):
    """Merge filters of a range; frequent n-grams are listed beside the filter."""

    def run(table: pa.Table) -> pa.Table:
        length, columns, counts = _merged(table, bits, known)
        data = encoded(columns, counts, length, bits, known)
        often = counts >= occurrences
        lanes = restored(unpacked([c[often] for c in columns], length, bits), bits)
        n = int(often.sum())
        ids = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * length, pa.int32()), pa.array(np.stack(lanes, 1).ravel().astype(np.int64)))
        whole = pa.array([0, n], pa.int32())
        return pa.table(
            {
                "length": pa.array([length], pa.int32()),
                "range": table.column("range").slice(0, 1),
                "slots": pa.array([len(counts)], pa.int64()),
                "filter": pa.array([data], pa.binary()),
                "phrases": pa.ListArray.from_arrays(whole, ids),
                "counts": pa.ListArray.from_arrays(whole, pa.array(counts[often])),
            }
        )

    return run


FINISHED_DDL = "length int, `range` bigint, slots bigint, filter binary, phrases array<array<bigint>>, counts array<bigint>"


@dataclass
class Counted:
    """What is counted: (lang, n), (id, lang, word, a) of frequent words, filters with their frequent n-grams."""

    totals: DataFrame
    words: DataFrame
    filters: DataFrame
    bits: int
    known: int


def count_phrases(docs: DataFrame, scratch: common.Scratch, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> Counted:
    plain = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    kind = "segment bigint, lang string, words array<string>, times array<bigint>, codes binary"
    segments = scratch.store(plain.mapInArrow(_segments, kind), "segments")
    each = segments.select("segment", "lang", F.posexplode(F.arrays_zip("words", "times")).alias("place", "x")).select(
        "segment", "lang", "place", F.col("x.words").alias("word"), F.col("x.times").alias("a")
    )
    totals = each.groupBy("lang").agg(F.sum("a").alias("n"))
    often = each.groupBy("lang", "word").agg(F.sum("a").alias("a")).where(F.col("a") >= limits.occurrences)
    often = scratch.store(often, "often").withColumn("_all", F.lit(0))
    words = common.number_within(often, ["_all"], F.xxhash64("lang", "word"), ["lang", "word"], "id", 1).drop("_all")
    words = scratch.store(words, "words")
    n_words, occurrences = words.agg(F.count(F.lit(1)), F.coalesce(F.sum("a"), F.lit(0))).first()
    bits = max(1, int(n_words).bit_length())
    known = min(bits, max(0, (occurrences * (limits.words - 1) // SLOTS).bit_length()))
    first = min(known, FAN_BITS)
    numbers = each.select("segment", "place", "lang", "word").join(words.select("lang", "word", "id"), ["lang", "word"])
    filters = (
        segments.select(F.col("segment").alias("of"), F.size("words").alias("n_words"), "codes").groupBy("of")
        .cogroup(numbers.select("segment", "place", "id").groupBy("segment"))
        .applyInArrow(_fragments(limits.words, bits, first), FRAGMENT_DDL)
    )
    if known > first:
        by = [F.col("length"), F.col("range"), F.pmod(F.xxhash64("segment"), F.lit(1 << (known - first))).alias("_part")]
        filters = filters.groupBy(*by).applyInArrow(_dealt_on(bits, first, known), FRAGMENT_DDL)
    merged = filters.groupBy("length", "range").applyInArrow(_finished(bits, known, limits.occurrences), FINISHED_DDL)
    return Counted(totals, words, scratch.store(merged, "filters"), bits, known)


# --- scores ----------------------------------------------------------------------------------------------------------


def _score() -> Column:
    return F.expr("cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0)) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")


def _scored(phrases: DataFrame, length: int, level: dict[int, DataFrame]) -> DataFrame:
    """Phrases of one length with text, language and the cut of least score."""
    cuts = []
    for k in range(1, length):
        head = level[k].select(F.col("phrase").alias("head"), F.col("a").alias(f"l{k}"), F.col("text").alias("_head"), F.col("lang").alias("_lang"))
        tail = level[length - k].select(F.col("phrase").alias("tail"), F.col("a").alias(f"r{k}"), F.col("text").alias("_tail"))
        phrases = phrases.join(head, F.slice("phrase", 1, k) == F.col("head")).join(tail, F.slice("phrase", k + 1, length - k) == F.col("tail"))
        if k == 1:
            phrases = phrases.withColumns({"text": F.concat_ws(" ", "_head", "_tail"), "lang": F.col("_lang")})
        phrases = phrases.drop("head", "tail", "_head", "_tail", "_lang")
        cuts.append((k, F.col(f"l{k}"), F.col(f"r{k}")))
    structs = [F.struct(F.lit(k).alias("k"), lk.alias("l"), rk.alias("r")) for k, lk, rk in cuts]
    each = phrases.withColumn("cut", F.explode(F.array(*structs))) if len(structs) > 1 else phrases.withColumn("cut", structs[0])
    each = each.select("phrase", "text", "lang", "a", F.col("cut.k").alias("k"), F.col("cut.l").alias("l"), F.col("cut.r").alias("r")).withColumn("score", _score())
    if len(structs) == 1:
        return each.drop("k")
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    return each.groupBy("phrase").agg(F.first("text").alias("text"), F.first("lang").alias("lang"), F.first("a").alias("a"), least).select(
        "phrase", "text", "lang", "a", "least.l", "least.r", "least.score"
    )


def _first(rows: DataFrame, first: int) -> DataFrame:
    """The first rows of each language. Each language is cut by slices before its slices meet."""
    order = [F.desc("score"), F.desc("a"), F.asc("text")]
    slice_ = F.pmod(F.xxhash64("phrase"), F.lit(common.slices(rows.sparkSession)))
    for by in ([F.col("lang"), slice_], [F.col("lang")]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= first)
    return rows


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """The first phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    scratch = common.Scratch(docs.sparkSession, "collocations")
    counted = count_phrases(docs, scratch, text_col, lang_col, limits)
    frequent = counted.filters.select("length", F.explode(F.arrays_zip("phrases", "counts")).alias("x")).select(
        "length", F.col("x.phrases").alias("phrase"), F.col("x.counts").alias("a")
    )
    level = {1: counted.words.select(F.array("id").alias("phrase"), F.col("word").alias("text"), "lang", "a")}
    for length in range(2, limits.words + 1):
        found = _scored(frequent.where(F.col("length") == length).drop("length"), length, level)
        level[length] = scratch.store(found, f"phrases-{length}")
    kept = level.get(limits.words)
    if limits.words < 2:
        raise ValueError("phrases have two words at least")
    for length in range(2, limits.words):
        # A phrase within a longer one lies within one of a word more, which occurs at least as often.
        within = level[length + 1].select(F.explode(F.array(F.slice("phrase", 1, length), F.slice("phrase", 2, length))).alias("phrase"), "a")
        most = within.groupBy("phrase").agg(F.max("a").alias("most"))
        free = level[length].join(most, "phrase", "left").where(f"most IS NULL OR 100 * most < {limits.contained_percent} * a").drop("most")
        kept = kept.unionByName(free)
    return (
        _first(kept, limits.first)
        .join(counted.totals, "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(common.table(spark, sf_dir, "documents"))


SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
  g AS (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM w CROSS JOIN (SELECT unnest([1, 2, 3]) AS m) WHERE len(w) >= m),
  f AS (SELECT lang, m, w[i:i + m - 1] AS ws, count(*) AS f FROM g GROUP BY ALL),
  n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
  c AS (SELECT * FROM f WHERE m > 1 AND f >= 10),
  k AS (SELECT *, unnest(range(1, m)) AS k FROM c),
  s AS (SELECT k.lang, k.m, k.ws, k.f AS a, k.k, l.f AS l, r.f AS r, (1000000::HUGEINT * k.f * k.f) // (l.f::HUGEINT * r.f) AS score
    FROM k JOIN f l ON l.lang = k.lang AND l.ws = k.ws[1:k.k] JOIN f r ON r.lang = k.lang AND r.ws = k.ws[k.k + 1:]),
  b AS (SELECT lang, m, ws, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1),
  d AS (SELECT lang, ws, max(f) AS most FROM (SELECT lang, ws[1:2] AS ws, f FROM c WHERE m = 3 UNION ALL SELECT lang, ws[2:3], f FROM c WHERE m = 3) GROUP BY ALL),
  o AS (SELECT b.lang, array_to_string(b.ws, ' ') AS phrase, a, l, r, score::BIGINT AS score FROM b LEFT JOIN d ON d.lang = b.lang AND d.ws = b.ws WHERE most IS NULL OR 100 * most < 50 * a)
SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o JOIN n ON n.lang = o.lang QUALIFY rank <= 2000
"""
