"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Whitespace of every word rule here, [\x20\x09-\x0D]; bytes.split() without an argument splits at the same six.
WHITESPACE = b" \t\n\v\f\r"


class Scratch:
    """Tables of one run in the folder that the cluster shares.

    A table written here survives the loss of any executor. Each run takes a folder of its own below
    `spark.checkpoint.dir`; a temporary folder of this machine serves local masters only.
    """

    def __init__(self, spark: SparkSession, label: str):
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="enrichlake-llm-")
        # Workers import these functions by name; where they see this folder, they need no further path.
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        self.spark = spark
        self.folder = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def store(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        """Write `df` as Parquet and read it back: lineage ends here, and later reads see fixed rows.

        Shuffle files of the steps before are of no use any more. Spark deletes them once the driver has found
        their plans to be garbage, so it is asked to look now rather than after its half hour.
        """
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(self.path(name))
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def bucketed(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Write `df` in buckets of `key`, as many as a shuffle has parts: a join on `key` moves the other side only.

        Buckets are known to the session's catalog, so the table has a name there until it is dropped.
        """
        writer = df.write.bucketBy(slices(self.spark), key).option("path", self.path(name))
        writer.saveAsTable(self._named(name))
        return self.spark.table(self._named(name))

    def _named(self, name: str) -> str:
        return "".join(c if c.isalnum() else "_" for c in f"{os.path.basename(self.folder)}_{name}")

    def drop(self, *names: str) -> None:
        """Delete tables of this run that no later step reads; without names all of them."""
        hadoop = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._named(name)}")
        for folder in map(self.path, names) if names else [self.folder]:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(spark: SparkSession) -> int:
    """Number of parts into which one hot key is split: as many as a shuffle has."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def number_within(
    df: DataFrame, keys: Sequence[str], spread: Column, order_by: Sequence[str], name: str, start: int = 0
) -> DataFrame:
    """Gapless numbers from `start` within each combination of `keys`, also when one key holds most rows.

    `spread` is a hash of the row; it deals every key over as many slices as a shuffle has parts. Each slice is
    numbered by itself and shifted by the sizes of the slices before it. `df` is read twice, so it has to be a
    stored table or cheap. Keys must not be NULL. The columns `_slice`, `_before` and `_n` are used inside.
    """
    cut = df.withColumn("_slice", F.pmod(spread, F.lit(slices(df.sparkSession))).cast("int"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    return (
        cut.withColumn("_n", F.row_number().over(within))
        .join(offsets, [*keys, "_slice"])
        .withColumn(name, (F.col("_before") + F.col("_n") - 1 + start).cast("long"))
        .drop("_slice", "_before", "_n")
    )


def parts(batch: pa.RecordBatch, text: str, budget: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cut a batch so that the texts of a part hold about `budget` bytes; NULL texts come as empty.

    A longer text is a part of its own, whole.
    """
    column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary())
    sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(column), 0), dtype=np.int64)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > budget:
            yield batch.slice(start, i - start), [x or b"" for x in column.slice(start, i - start).to_pylist()]
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start), [x or b"" for x in column.slice(start).to_pylist()]


def word_codes(words: Sequence[Sequence[bytes]]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """All words of some documents as numbers: (code per word, words by code, end of each document)."""
    ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
    flat = pa.array([x for w in words for x in w], pa.large_binary()).dictionary_encode()
    return np.asarray(flat.indices, dtype=np.int64), flat.dictionary, ends


def dense(keys: np.ndarray) -> np.ndarray:
    """Number equal keys alike, from 0."""
    return pd.factorize(keys)[0].astype(np.int64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: a bijection that spreads every bit (unsigned arithmetic wraps)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xA0761D6478BD642F)
        x ^= x >> np.uint64(32)
    return x


def rows_of(batches: Iterable[dict[str, object]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Columns to Arrow batches of a fixed schema."""
    for columns in batches:
        yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)
