"""Connected components of an edge table."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def components(edges: DataFrame, scratch: common.Scratch, name: str) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its smallest node.

    `edges` has bigint columns a and b. Rounds hang each node's larger neighbours on its smallest one, then each
    node and its smaller neighbours on the smallest of them, until nothing changes. A node with very many edges is
    reduced within tasks for its minimum, and Spark splits its rows in the join.
    """
    now = scratch.store(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct(), f"{name}-0"
    )
    mark = None
    for i in count(1):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m")).select("w", F.least("w", "m").alias("m"))
        large = both.where("v > u").join(least, F.col("u") == F.col("w")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = scratch.store(large.unionByName(now).distinct(), f"{name}-{i}-large") if i == 1 else large.distinct()
        least = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        joined = large.join(least, F.col("u") == F.col("w"))
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        now = scratch.store(small.distinct(), f"{name}-{i}")
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(row) == mark:
            break
        mark = tuple(row)
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
