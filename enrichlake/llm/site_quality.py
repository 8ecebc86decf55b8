"""Quality classifier with priors of sites and paths, by hierarchical empirical Bayes.

Document evidence is the log odds of a logistic regression over distinct words and a few surface marks (share of
capitals, of symbols, of distinct words), less the log odds of the sample. It is fitted on at most `SAMPLE` labelled
documents, drawn by a hash of their ids, and over at most `FEATURES` features per target, those with the clearest
difference between classes. Both bounds are parameters of the model alone: all documents are scored, by whole texts.

All documents then count towards their site and path: expected numbers of bad documents are summed by path and by
host. A host's rate is drawn towards the global rate, a path's rate towards its host's, the more so the fewer
documents it has; how strongly follows from how much rates differ between hosts, and between paths of a host, beyond
chance (method of moments). A document's posterior joins its evidence with the rate of its path, left out itself.

Two targets are judged alike: low quality and toxicity. A document is kept if neither is likelier than not.

Defined results: NULL texts count as empty. NULL hosts and paths are the empty name. With no labels of a class there
is no evidence for it and nothing is rejected. Repeated rows count each. Labels that are NULL or contradict each other
for an id count as they stand; labels without a document are unused. Further columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE = 20_000
FEATURES = 4096
#: Bytes of a word that also count as a feature, for words that are inflected.
BEGINNINGS = (4, 6)
#: A feature may be used if it is in so many documents and classes differ by this many standard errors.
LEAST_DOCUMENTS, LEAST_Z = 5, 4.0
#: Weight of the squared coefficients, Newton steps, and steps of conjugate gradients in each.
RIDGE, NEWTON, GRADIENTS = 0.2, 12, 30
EDGES = b".,;:!?\"'()[]"
#: Strength of a prior, in documents.
STRENGTH = (1.0, 1e6)
TARGETS = ("bad", "toxic")


def features(text: bytes) -> set[bytes]:
    """Distinct words in lower case without punctuation at their ends, their beginnings, and surface marks.

    Beginnings stand in front of a space and marks hold one, so neither is a word.
    """
    words = text.split()
    n = len(words)
    letters = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, lower = int(letters[65:91].sum()), int(letters[97:123].sum())
    symbols = sum(int(letters[ord(c)]) for c in "#*$%&|<>!")
    length = n.bit_length()
    found = {w.lower().strip(EDGES) for w in words}
    found.discard(b"")
    found |= {w[:k] + b" " for w in found for k in BEGINNINGS if len(w) > k}
    marks = (
        f"upper {10 * upper // max(1, upper + lower)}",
        f"symbols {min(20, 10 * symbols // max(1, n))}",
        f"distinct {length} {10 * len(set(words)) // max(1, n)}",
        f"length {min(length, 5)}",
    )
    return found | {m.encode() for m in marks}


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = {t: Counter() for t in ("n", *TARGETS)}

    def flushed() -> pa.RecordBatch:
        names = list(counts["n"])
        columns = [pa.array(names, pa.binary())] + [pa.array([counts[t][x] for x in names], pa.int64()) for t in counts]
        for c in counts.values():
            c.clear()
        return pa.RecordBatch.from_arrays(columns, names=["feature", *counts])

    for batch in batches:
        for part, texts in common.parts(batch, "text"):
            for text, bad, toxic in zip(texts, part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                found = features(text)
                counts["n"].update(found)
                if bad:
                    counts["bad"].update(found)
                if toxic:
                    counts["toxic"].update(found)
            if len(counts["n"]) > 300_000:
                yield flushed()
    yield flushed()


def _active(index: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                active = [sorted(index[f] for f in features(t) & index.keys()) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(active, pa.list_(pa.int32())), part.column(1), part.column(2)], names=["active", *TARGETS])

    return run


def regress(row: np.ndarray, col: np.ndarray, y: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge over 0/1 features, given by the places of the ones: (coefficients, constant).

    Newton's method; each step solves its equations by conjugate gradients.
    """
    n = len(y)
    row, col = np.concatenate([row, np.arange(n)]), np.concatenate([col, np.full(n, width)])
    w = np.zeros(width + 1)
    w[width] = math.log((y.sum() + 1) / (n - y.sum() + 1))
    ridge = np.full(width + 1, RIDGE)
    ridge[width] = 1e-6
    times = lambda v: np.bincount(row, v[col], minlength=n)
    back = lambda u: np.bincount(col, u[row], minlength=width + 1)
    for _ in range(NEWTON):
        p = 1 / (1 + np.exp(-np.clip(times(w), -30, 30)))
        slope, curve = back(p - y) + ridge * w, p * (1 - p) + 1e-9
        step, r = np.zeros_like(w), -slope
        d, rr = r.copy(), float(r @ r)
        for _ in range(GRADIENTS):
            if rr < 1e-12:
                break
            h = back(curve * times(d)) + ridge * d
            a = rr / float(d @ h)
            step, r = step + a * d, r - a * h
            d, rr = r + (float(r @ r) / rr) * d, float(r @ r)
        w = w + step
        if np.abs(step).max() < 1e-4:
            break
    return w[:width], float(w[width])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most: int = FEATURES) -> tuple[dict[bytes, tuple[float, ...]], dict[str, tuple[float, float]]]:
    """(weights by feature, (constant, rate) by target). `docs` has doc_id and text, `labels` doc_id, quality, toxic."""
    drawn = (
        labels.select(F.col("doc_id").cast("bigint").alias("_id"), (F.col("quality") == 0).alias("bad"), (F.col("toxic") == 1).alias("toxic"))
        .orderBy(F.xxhash64("_id"), "_id", "bad", "toxic")
        .limit(sample)
    )
    scratch = common.Scratch(docs.sparkSession, "site-quality-fit")
    # At most `sample` rows of a few small columns are sent to the tasks. An id may stand for many rows: equal texts count
    # once, and again no more than `sample` of what is left is fitted.
    found = docs.join(F.broadcast(drawn), F.col("doc_id").cast("bigint") == F.col("_id")).select("_id", "text", "bad", "toxic")
    found = found.withColumn("_text_key", F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    keys = ["_id", "_text_key", "bad", "toxic"]
    kept = found.select(*keys).distinct().orderBy(F.xxhash64("_id", "_text_key"), *keys).limit(sample)
    same = [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys]
    kept = scratch.store(kept.select(*[F.col(k).alias(f"_of_{k}") for k in keys]), "kept")
    rows = found.join(F.broadcast(kept), same).groupBy(*keys).agg(F.first("text").alias("text"))
    rows = scratch.store(rows.select("text", "bad", "toxic"), "sample")
    kind = "feature binary, n bigint, bad bigint, toxic bigint"
    counts = rows.mapInArrow(_feature_counts, kind).groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", *TARGETS)])
    counts = scratch.store(counts.where(F.col("n") >= LEAST_DOCUMENTS), "counts")
    total = rows.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(F.col(t).cast("bigint")), F.lit(0)) for t in TARGETS]).first()
    whole = dict(zip(("n", *TARGETS), total, strict=True))
    index: dict[bytes, int] = {}
    usable = [t for t in TARGETS if 0 < whole[t] < whole["n"]]
    for target in usable:
        inside, outside = whole[target], whole["n"] - whole[target]
        p, q, m = F.col(target) / inside, (F.col("n") - F.col(target)) / outside, (F.col("n") + 1) / (whole["n"] + 2)
        z = F.abs(p - q) / F.sqrt(m * (1 - m) * (1 / inside + 1 / outside))
        for r in counts.withColumn("z", z).where(F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "feature").limit(most).select("feature").collect():
            index.setdefault(bytes(r["feature"]), len(index))
    weights = np.zeros((len(TARGETS), len(index)))
    constants = {t: (0.0, 0.0 if t not in usable else whole[t] / whole["n"]) for t in TARGETS}
    if index:
        found = rows.mapInArrow(_active(index), "active array<int>, bad boolean, toxic boolean").toPandas()
        row = np.repeat(np.arange(len(found)), found["active"].map(len))
        col = np.concatenate([np.asarray(x, np.int64) for x in found["active"]])
        for i, t in enumerate(TARGETS):
            if t in usable:
                y = found[t].fillna(False).to_numpy(float)
                weights[i], constant = regress(row, col, y, len(index))
                constants[t] = constant - math.log(y.sum() / (len(y) - y.sum())), constants[t][1]
    return {f: tuple(weights[:, k]) for f, k in index.items()}, constants


def _evidence(weights: dict[bytes, tuple[float, ...]], constants: list[float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in common.parts(batch, "text"):
                sums = np.tile(constants, (len(texts), 1))
                for i, text in enumerate(texts):
                    for f in sorted(features(text) & weights.keys()):
                        sums[i] += weights[f]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *map(pa.array, sums.T)], names=[*part.schema.names[:-1], *TARGETS])

    return run


def _logit(p: Column) -> Column:
    safe = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), p))
    return F.log(safe / (1 - safe))


def _chance(logit: Column) -> Column:
    return 1 / (1 + F.exp(-logit))


def strength(groups: DataFrame, rate: Column) -> float:
    """Documents that a prior is worth, for groups with `n`, `s` (expected number) and the mean `rate` of their parent."""
    chance = F.sum(rate * (1 - rate) * F.col("n"))
    row = groups.agg(
        F.sum("n").alias("n"), chance.alias("spread"), F.sum(rate * (1 - rate)).alias("by_chance"), F.sum(F.col("n") * (F.col("s") / F.col("n") - rate) ** 2).alias("seen")
    ).first()
    if not row["n"]:
        return STRENGTH[0]
    between = (row["seen"] - row["by_chance"]) / row["n"]
    within = row["spread"] / row["n"]
    return min(max(within / between - 1, STRENGTH[0]), STRENGTH[1]) if between > 0 and math.isfinite(within / between) else STRENGTH[1]


def path_rates(evidence: DataFrame, rates: dict[str, float]) -> DataFrame:
    """(host, path, n, and by target: sum and shrunk rate of the host, strength at path level)."""
    paths = evidence.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(_chance(F.col(t) + _logit(F.lit(rates[t])))).alias(f"s_{t}") for t in TARGETS]
    )
    paths = common.Scratch(evidence.sparkSession, "site-quality-paths").store(paths, "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), *[F.sum(f"s_{t}").alias(f"s_{t}") for t in TARGETS])
    whole = hosts.agg(F.sum("n").alias("n"), *[F.sum(f"s_{t}").alias(t) for t in TARGETS]).first()
    out = paths
    for t in TARGETS:
        mean = F.lit(whole[t] / whole["n"] if whole["n"] else 0.0)
        k = strength(hosts.withColumn("s", F.col(f"s_{t}")), mean)
        shrunk = hosts.select("host", ((F.col(f"s_{t}") + k * mean) / (F.col("n") + k)).alias(f"host_{t}"))
        out = out.join(shrunk, "host")
        out = out.withColumn(f"k_{t}", F.lit(strength(out.withColumn("s", F.col(f"s_{t}")), F.col(f"host_{t}"))))
    return out


def classify(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "concat_ws('/', source, lang)", sample: int = SAMPLE) -> DataFrame:
    """(doc_id, host, path, p_bad, p_toxic, path rates, kept) per row; `host` and `path` are SQL expressions."""
    spark = docs.sparkSession
    weights, constants = fit(docs.select("doc_id", "text"), labels, sample)
    rates = {t: rate for t, (_, rate) in constants.items()}
    name = lambda e: F.coalesce(F.expr(e).cast("string"), F.lit(""))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), name(host).alias("host"), name(path).alias("path"), F.col("text").cast("string").alias("text"))
    evidence = plain.mapInArrow(_evidence(weights, [constants[t][0] for t in TARGETS]), "doc_id bigint, host string, path string, bad double, toxic double")
    scratch = common.Scratch(spark, "site-quality")
    evidence = scratch.store(evidence, "evidence")
    known = scratch.store(path_rates(evidence, rates), "path-rates")
    joined = evidence.join(known, ["host", "path"])
    for t in TARGETS:
        own = _chance(F.col(t) + _logit(F.lit(rates[t])))
        rate = (F.greatest(F.lit(0.0), F.col(f"s_{t}") - own) + F.col(f"k_{t}") * F.col(f"host_{t}")) / (F.col("n") - 1 + F.col(f"k_{t}"))
        joined = joined.withColumn(f"path_{t}", rate).withColumn(f"p_{t}", _chance(F.col(t) + _logit(F.col(f"path_{t}"))))
    kept = (F.col("p_bad") <= 0.5) & (F.col("p_toxic") <= 0.5) if weights else F.lit(True)
    return joined.select("doc_id", "host", "path", "p_bad", "p_toxic", "path_bad", "path_toxic", kept.alias("kept"))


def op5_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))
