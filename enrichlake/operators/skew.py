"""Row numbers, top-k and join keys that hold up under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed


def number_rows(
    df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (), name: str = "rn"
) -> DataFrame:
    """Exact 1-based row numbers per key without ever putting a whole key in one task.

    Rows are range-partitioned on (key, order) into slices, and the slice of each
    row is fixed by a checkpoint. Each slice is numbered by itself and shifted by
    the size of the slices before it. The order columns have to identify a row
    within its key, otherwise the slices could not split a run of ties. NULL is a key
    like any other. `df` is run once: sampling for the ranges reads its checkpoint.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = list(partition_by)
    sliced = checkpointed(
        checkpointed(df).repartitionByRange(slices, *keys, *order_by).withColumn("_slice", F.spark_partition_id())
    )
    # One row per (key, slice): slices plus keys at most, since slices follow the key order.
    before = Window.partitionBy(*keys, *([] if keys else [F.lit(0)])).orderBy("_slice")
    offsets = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset", F.coalesce(F.sum("_n").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        )
        .drop("_n")
    )
    within = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    same = F.col("_slice") == F.col("_of_slice")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    offsets = offsets.select(*[F.col(c).alias(f"_of_{c.removeprefix('_')}") for c in (*keys, "_slice")], "_offset")
    return (
        sliced.join(offsets, same)
        .withColumn(name, F.col("_offset") + F.row_number().over(within))
        .drop("_slice", "_offset", "_of_slice", *[f"_of_{k}" for k in keys])
    )


def top_k(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column], k: int, rank: str = "_rank") -> DataFrame:
    """The first `k` rows of each key.

    Spark cuts each task to k rows a key before the shuffle as long as k is within
    `spark.sql.optimizer.windowGroupLimitThreshold`; raise it for a larger k.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= k)


def spread_scan(df: DataFrame) -> DataFrame:
    """Rebalance a scan that yields fewer tasks than there are cores.

    Text work costs far more than moving the text once. A table of many files has
    more splits than cores, and then this does nothing.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.rdd().getNumPartitions() < cores else df


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Join key in which every NULL becomes a value of its own.

    An outer join sends all NULL keys to one task although none can match. The
    stand-in starts with a character no real key holds.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id.cast("string")))
