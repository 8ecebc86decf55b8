"""Quality rules: fixed counts, then divergence of a document's histograms from those of its language.

A language reference is gathered from all documents of the language: the histogram over character classes and
the histogram over the language's most common words. A document is compared with it by Jensen-Shannon distance
(base 2, between 0 and 1). Histograms of few observations differ by chance, so short documents are not judged,
and the limit for words allows for the divergence that a sample of that many words has on average.

Defined results: NULL and empty texts have no words and fail the base rule. A NULL language is a language of its
own, apart from an empty one. A language with less text than `Limits.reference_words` gives no reference and nothing of it is judged.
Repeated rows are judged row by row, alike. Other columns are neither read nor changed.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from . import common

REPEAT_WORDS = 8
SYMBOLS = "#*$%&|<>"
#: Bytes of text whose words are held at once.
PART_BYTES = 1 << 20
#: Distinct words that a task counts before it hands them on; Spark adds the counts up.
HELD_WORDS = 200_000
#: Character classes: lower and upper ASCII letters, characters beyond ASCII, digits, whitespace, punctuation, the rest.
CLASSES = 7
SKIPPED = CLASSES  # bytes that continue a character


@dataclass(frozen=True)
class Limits:
    """Parameters of the verdict."""

    common_words: int = 64
    reference_words: int = 2000
    class_min_words: int = 50
    class_distance: float = 0.30
    word_min_words: int = 100
    word_distance: float = 0.30


def _class_of_byte() -> np.ndarray:
    lut = np.full(256, 6, np.int64)
    for b in range(256):
        ch = chr(b)
        if b >= 0xC0:
            lut[b] = 2
        elif b >= 0x80:
            lut[b] = SKIPPED
        elif ch.islower():
            lut[b] = 0
        elif ch.isupper():
            lut[b] = 1
        elif ch.isdigit():
            lut[b] = 3
        elif bytes([b]) in common.WHITESPACE:
            lut[b] = 4
        elif ch in ".,;:!?'\"()-":
            lut[b] = 5
    return lut


CLASS_OF_BYTE = _class_of_byte()


def class_counts(text: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF_BYTE[np.frombuffer(text, np.uint8)], minlength=CLASSES + 1)[:CLASSES]


def _language_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of one task by language: words as they are, classes under a number."""
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def rows(lang: str, word: pa.Array, kind: pa.Array, n: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), word, kind, n], names=["lang", "word", "class", "n"])

    def flushed() -> Iterator[pa.RecordBatch]:
        while words:  # one language after the other, each let go before the next
            lang, c = words.popitem()
            yield rows(lang, pa.array(list(c), pa.binary()), pa.nulls(len(c), pa.int32()), pa.array(list(c.values()), pa.int64()))
        for lang, c in classes.items():
            yield rows(lang, pa.nulls(CLASSES, pa.binary()), pa.array(range(CLASSES), pa.int32()), pa.array(c, pa.int64()))
        classes.clear()

    for batch in batches:
        for part, texts in common.parts(batch, "text", PART_BYTES):
            for lang, text in zip(part.column(1).to_pylist(), texts, strict=True):
                words.setdefault(lang, Counter()).update(text.lower().split())
                classes[lang] = classes.get(lang, 0) + class_counts(text)
            if sum(map(len, words.values())) > HELD_WORDS:
                yield from flushed()
    yield from flushed()


def language_references(docs: DataFrame, limits: Limits, scratch: common.Scratch) -> DataFrame:
    """(ref_lang, reference) per language with enough text; `docs` has text and lang, a key that is never NULL.

    A reference is packed by `_packed`: common words, their counts and that of all other words, counts of classes.
    """
    counted = (
        docs.select("text", "lang")
        .mapInArrow(_language_counts, "lang string, word binary, class int, n bigint")
        .groupBy("lang", "word", "class")
        .agg(F.sum("n").alias("n"))
    )
    counted = scratch.store(counted, "counts")
    words = counted.where("word IS NOT NULL")
    # A language's top words; Spark cuts each task to that many before it moves rows.
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    top = (
        words.withColumn("r", F.row_number().over(first))
        .where(F.col("r") <= limits.common_words)
        .groupBy("lang")
        .agg(F.sort_array(F.collect_list(F.struct("r", "word", "n"))).alias("top"))
    )
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    classes = (
        counted.where("class IS NOT NULL")
        .groupBy("lang")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("class", "n"))), lambda x: x["n"]).alias("ref_classes"))
    )
    joined = totals.where(F.col("total") >= limits.reference_words).join(top, "lang").join(classes, "lang")
    return joined.select("lang", "top", "total", "ref_classes").mapInArrow(_packed, "ref_lang string, reference binary")


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """References as bytes: number of words, class counts, word counts, then the words, which hold no space."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            counts = [x["n"] for x in r["top"]]
            numbers = [len(counts), *r["ref_classes"], *counts, r["total"] - sum(counts)]
            out.append(np.array(numbers, "<i8").tobytes() + b" ".join(x["word"] for x in r["top"]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["ref_lang", "reference"])


class Reference:
    """Histograms of a language."""

    def __init__(self, packed: bytes):
        n = int(np.frombuffer(packed, "<i8", 1)[0])
        numbers = np.frombuffer(packed, "<i8", CLASSES + n + 1, 8).astype(float)
        self.classes, self.counts = numbers[:CLASSES], numbers[CLASSES:]
        self.words = packed[8 * (CLASSES + n + 2) :].split(b" ")


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    if p.sum() == 0 or q.sum() == 0:
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2

    def bits(a: np.ndarray) -> float:
        some = a > 0
        return float(np.sum(a[some] * np.log2(a[some] / m[some])))

    return math.sqrt(max(0.0, (bits(p) + bits(q)) / 2))


def repeated_words(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words per document that lie in an 8-word window found twice or more in it.

    Equal windows are found exactly: pairs of words are numbered, then pairs of pairs, then pairs of those.
    """
    docs = len(ends)
    starts = np.concatenate([[0], ends[:-1]]) if docs else ends
    width, ids = 1, codes
    while width < REPEAT_WORDS and len(ids) > width:
        ids = common.dense(ids[:-width] * (int(ids.max()) + 1) + ids[width:])
        width *= 2
    if width < REPEAT_WORDS:
        return np.zeros(docs, np.int64)
    doc = np.repeat(np.arange(docs), ends - starts)
    at = np.flatnonzero(np.arange(len(ids)) + REPEAT_WORDS <= ends[doc[: len(ids)]])
    same = common.dense(ids[at] * docs + doc[at])
    again = at[np.bincount(same)[same] > 1] if len(at) else at
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + REPEAT_WORDS, -1)
    return np.bincount(doc, np.cumsum(edge[:-1]) > 0, minlength=docs).astype(np.int64)


def base_counts(texts: list[bytes]) -> tuple[dict[str, np.ndarray], list[list[bytes]]]:
    words = [t.split() for t in texts]
    codes, _, ends = common.word_codes(words)
    spaces = common.WHITESPACE.decode()
    chars, symbols, repeated_lines = [], [], []
    for text in texts:
        decoded = text.decode()
        chars.append(len(decoded) - sum(map(decoded.count, spaces)))
        symbols.append(sum(map(decoded.count, SYMBOLS)))
        lines = [x for x in text.split(b"\n") if x.strip()]
        repeated_lines.append(len(lines) - len(set(lines)))
    return {
        "n_words": np.array([len(w) for w in words], np.int64),
        "word_chars": np.array(chars, np.int64),
        "n_symbols": np.array(symbols, np.int64),
        "n_dup_lines": np.array(repeated_lines, np.int64),
        "n_repeat_words": repeated_words(codes, ends),
    }, words


MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, class_distance double, word_distance double, base_failed boolean, kept boolean"


def judged(texts: list[bytes], packed: list[bytes | None], limits: Limits, known: dict[bytes, Reference]) -> dict[str, np.ndarray]:
    """The measures and the verdict of some texts, each with its language's reference; `known` keeps those unpacked."""
    out, words = base_counts(texts)
    n = out["n_words"]
    class_d, word_d = np.zeros(len(texts)), np.zeros(len(texts))
    for i, reference in enumerate(packed):
        if reference is None or n[i] < limits.class_min_words:
            continue
        if reference not in known:
            if len(known) > 256:
                known.clear()
            known[reference] = Reference(reference)
        ref = known[reference]
        class_d[i] = js_distance(class_counts(texts[i]), ref.classes)
        if n[i] >= limits.word_min_words:
            seen = Counter(x.lower() for x in words[i])
            mine = np.array([seen[w] for w in ref.words], float)
            word_d[i] = js_distance(np.append(mine, n[i] - mine.sum()), ref.counts)
    by_chance = limits.common_words / (8 * math.log(2) * np.maximum(n, 1))
    failed = (n < 20) | (100 * out["n_repeat_words"] > 30 * n)
    fits = (class_d <= limits.class_distance) & (word_d**2 <= by_chance + limits.word_distance**2)
    return out | {"class_distance": class_d, "word_distance": word_d, "base_failed": failed, "kept": ~failed & fits}


def _with_reference(docs: DataFrame, text_col: str, lang_col: str, limits: Limits) -> DataFrame:
    """`docs` with `_text`, and `_reference` where its language has one. Spark broadcasts the references by their size."""
    lang = F.col(f"`{lang_col}`").cast("string")
    key = F.when(lang.isNull(), "null").otherwise(F.concat(F.lit("="), lang))
    text = F.col(f"`{text_col}`").cast("string")
    scratch = common.Scratch(docs.sparkSession, "quality-rules")
    references = scratch.store(language_references(docs.select(text.alias("text"), key.alias("lang")), limits, scratch), "references")
    scratch.drop("counts")
    with_key = docs.withColumns({"_text": text, "_key": key})
    return with_key.join(references.withColumnRenamed("reference", "_reference"), F.col("_key") == F.col("ref_lang"), "left").drop("_key", "ref_lang")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", limits: Limits = Limits()) -> DataFrame:
    """One row per document: its id, the base counts, both distances, `base_failed` and `kept`.

    Two passes over the texts. No text is moved unless the references are too large for Spark to broadcast, which
    it decides from the size of the stored table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, Reference] = {}
        for batch in batches:
            for part, texts in common.parts(batch, "_text", PART_BYTES):
                out = judged(texts, part.column(2).to_pylist(), limits, known)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, out.values())], names=[id_col, *out])

    plain = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in ((id_col, "_id"), (text_col, "_t"), (lang_col, "_l"))])
    rows = _with_reference(plain, "_t", "_l", limits).select("_id", "_text", "_reference")
    out_type = StructType([StructField(id_col, plain.schema["_id"].dataType), *StructType.fromDDL(MEASURES)])
    return rows.mapInArrow(run, out_type)


def kept_documents(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """The rows of `docs` that pass, with their columns as they are.

    Rows stay in the JVM; a text leaves it once and only the verdict comes back.
    """

    @F.arrow_udf("boolean")
    def keeps(text: pa.Array, reference: pa.Array) -> pa.Array:
        known: dict[bytes, Reference] = {}
        batch = pa.RecordBatch.from_arrays([text, reference], names=["text", "reference"])
        each = [judged(texts, part.column(1).to_pylist(), limits, known)["kept"] for part, texts in common.parts(batch, "text", PART_BYTES)]
        return pa.array(np.concatenate(each) if each else np.zeros(0, bool))

    names = [f"_{i}" for i in range(len(docs.columns))]  # columns of any name, also those used inside
    plain = docs.toDF(*names)
    at = {c: n for c, n in zip(docs.columns, names, strict=True)}
    rows = _with_reference(plain, at["text"], at["lang"], limits)
    return rows.where(keeps("_text", "_reference")).select(*names).toDF(*docs.columns)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(common.table(spark, sf_dir, "documents")).drop("class_distance", "word_distance")
