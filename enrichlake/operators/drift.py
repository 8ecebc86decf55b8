"""Q10, Q14: empty-rate drift over an append-only history of observations.

History rows: `field` (with its namespace, if any), `ts`, `seq`, `is_empty`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import catalogs as cat
from .skew import number_rows

BLOCK_ROWS = 16_384


def history_key(field: Column, namespace: str | None) -> Column:
    return F.concat(F.lit(f"{namespace}:"), field) if namespace else field


def read_history(history: DataFrame, field: str, namespace: str | None = None) -> DataFrame:
    """Q14: observations of one exact key; namespaces never mix."""
    return history.where(F.col("field") == (f"{namespace}:{field}" if namespace else field))


def exceeds_threshold(is_empty: Column, n: Column, empties: Column, min_history: int = cat.DRIFT_MIN_HISTORY) -> Column:
    """TRUE when an empty value lies above mean + 2 sample deviations of the n before it.

    With k empties among n the test `1 > k/n + 2*sqrt(k(n-k) / (n(n-1)))` is the
    same as `(n-k)(n-1) > 4kn`, which whole numbers decide exactly.
    """
    return is_empty & (n >= min_history) & ((n - empties) * (n - 1) > 4 * empties * n)


def drift_flags(history: DataFrame, window: int = cat.DRIFT_WINDOW, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Q10: add `previous`, `previous_empty` and `drifting` to every observation.

    There are only a few fields, and one of them may hold most rows, so a window
    per field would run in a handful of tasks. Rows are numbered per field, cut
    into blocks of `block_rows`, and the last `window - 1` rows of a block are
    copied to the next one; each block is then a small window of its own.
    """
    halo = window - 1
    if block_rows < halo:
        raise ValueError("a block must hold at least the window")
    numbered = number_rows(history, ["ts", "seq"], ["field"])
    offset = F.col("rn") - 1
    block = F.floor(offset / block_rows)
    own = F.struct(block.alias("block"), F.lit(True).alias("own"))
    copy = F.struct((block + 1).alias("block"), F.lit(False).alias("own"))
    placed = numbered.withColumn(
        "_at",
        F.explode(F.when(offset % block_rows >= block_rows - halo, F.array(own, copy)).otherwise(F.array(own))),
    ).select("*", F.col("_at.block").alias("_block"), F.col("_at.own").alias("_own")).drop("_at")
    before = Window.partitionBy("field", "_block").orderBy("rn").rowsBetween(-halo, -1)
    n, empties = F.col("previous"), F.col("previous_empty")
    return (
        placed.withColumns(
            {
                "previous": F.count(F.lit(1)).over(before),
                "previous_empty": F.coalesce(F.sum(F.col("is_empty").cast("int")).over(before), F.lit(0)),
            }
        )
        .where("_own")
        .withColumn("drifting", exceeds_threshold(F.col("is_empty").cast("boolean"), n, empties))
        .drop("_block", "_own", "rn")
    )
