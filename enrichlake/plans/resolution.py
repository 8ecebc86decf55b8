"""R1, R8 for sources that come one after the other: marks are kept, and only touched entities are resolved again.

A value's marks (best rank, newest observation, number of votes ...) can be merged, so a delivery is reduced to marks by
itself and stored; candidates are not needed any more. Entities it names are read back from all deliveries, merged and
resolved; all other entities are left out before anything is aggregated. Folders below `path`:

    marks/delivery=<id>/bucket=<b>     marks of one delivery, by bucket of the entity
    resolved/delivery=<id>             entities that the delivery touched, resolved with all that came so far
    log/delivery=<id>                  one row (number), written last: it makes the delivery count

Buckets without a touched entity are not scanned. A delivery that is sent again replaces its own folders and becomes the
newest; the entities of its first version count as touched. `ord` orders the candidates of an entity over all deliveries.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.resolve import Chains, Rule, candidate_marks, merge_marks, resolve_marks
from ..session import checkpointed

LOG = "number bigint, delivery string"


class Resolution:
    def __init__(self, spark: SparkSession, path: str, rules: Mapping[str, Rule], default: Rule = Rule(()), buckets: int = 64):
        self.spark, self.path, self.chains, self.buckets = spark, path.rstrip("/"), Chains(rules, default), buckets

    def _folder(self, table: str, delivery: str) -> str:
        return f"{self.path}/{table}/delivery={delivery}"

    def log(self) -> DataFrame:
        """(number, delivery) of the deliveries that count."""
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.path}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LOG)

    def _known(self) -> dict[str, int]:
        """Deliveries so far: one small row each."""
        return {r["delivery"]: r["number"] for r in self.log().collect()}

    def _stored(self, table: str, deliveries: list[str], schema: StructType) -> DataFrame:
        """Rows of some deliveries, with `delivery`."""
        schema = StructType([*schema.fields, StructField("delivery", StringType())])
        read = self.spark.read.schema(schema).option("basePath", f"{self.path}/{table}")
        return read.parquet(*[self._folder(table, d) for d in deliveries])

    def deliver(self, candidates: DataFrame, delivery: str) -> DataFrame:
        """Keep a delivery of candidates; the rows of all entities that it touches, resolved anew."""
        known = self._known()
        bucket = F.pmod(F.xxhash64("entity_id"), F.lit(self.buckets)).cast("int")
        marks = candidate_marks(candidates, self.chains).withColumn("bucket", bucket)
        entities = candidates.select("entity_id")
        if delivery in known:
            entities = entities.unionByName(self._stored("marks", [delivery], marks.schema).select("entity_id"))
        touched = checkpointed(entities.distinct().withColumn("bucket", bucket))
        # One file a bucket, more only where a bucket is too large for one task.
        marks.hint("rebalance", F.col("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(self._folder("marks", delivery))
        met = [r["bucket"] for r in touched.select("bucket").distinct().collect()]  # `buckets` numbers at most
        stored = self._stored("marks", [*(d for d in known if d != delivery), delivery], marks.schema).where(F.col("bucket").isin(met))
        # Null-safe: candidates without an entity are one entity, as in a single run.
        again = touched.select(F.col("entity_id").alias("_of"))
        same = F.col("entity_id").eqNullSafe(F.col("_of"))
        merged = merge_marks(stored.join(again, same, "left_semi").drop("bucket", "delivery"), self.chains)
        resolved = resolve_marks(merged, self.chains)
        # An entity that a new version of the delivery took away leaves a row without a field.
        rows = again.join(resolved, same, "left").select(F.col("_of").alias("entity_id"), *[c for c in resolved.columns if c != "entity_id"])
        rows.write.mode("overwrite").parquet(self._folder("resolved", delivery))
        row = self.spark.createDataFrame([(max(known.values(), default=0) + 1,)], "number bigint")
        row.coalesce(1).write.mode("overwrite").parquet(self._folder("log", delivery))
        return self.spark.read.schema(rows.schema).parquet(self._folder("resolved", delivery)).where("field IS NOT NULL")

    def resolved(self) -> DataFrame:
        """All entities and fields as the last delivery that touched the entity left them."""
        kind = resolve_marks(merge_marks(candidate_marks(self._no_candidates(), self.chains), self.chains), self.chains).schema
        known = self._known()
        if not known:
            return self.spark.createDataFrame([], kind)
        first = next(iter(known))
        kind["entity_id"].dataType = self.spark.read.parquet(self._folder("resolved", first)).schema["entity_id"].dataType
        number = F.element_at(F.create_map(*[F.lit(x) for d, n in known.items() for x in (d, n)]), F.col("delivery"))
        rows = self._stored("resolved", list(known), kind).withColumn("_number", number)
        newest = F.max("_number").over(Window.partitionBy("entity_id"))
        return rows.withColumn("_newest", newest).where("_number = _newest AND field IS NOT NULL").drop("_number", "_newest", "delivery")

    def _no_candidates(self) -> DataFrame:
        return self.spark.createDataFrame([], "entity_id bigint, field string, ord bigint, source string, value string")
