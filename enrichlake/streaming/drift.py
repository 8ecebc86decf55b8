"""Q10 while observations arrive: drift in the order of events, whatever the order of arrival.

What the watermark has passed is complete, is put in order of (ts, seq) and tested like in a batch. Nothing of that is
held in memory: each micro-batch keeps tables below the checkpoint, in folders of its own, and reads those of the one
before it.

    drift/arrived/batch=<id>   the observations of the micro-batch
    drift/waiting/batch=<id>   those that wait for the watermark after it
    drift/tails/batch=<id>     the last `window - 1` observations of every key after it
    drift/mark/batch=<id>      the watermark after it, written last

So a field's backlog is worked on by all tasks, and a micro-batch that is run again replaces its own folders. An
observation that comes later than the watermark allows can no longer stand in its place; it is left out and counted, see
:func:`late_rows`. Observations without a time come before all others and never wait. Times lie before 2262.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import catalogs as cat
from ..plans.history import ROW, TAIL, tested

FLAGS = "field string, ts timestamp, seq bigint, is_empty boolean, previous bigint, previous_empty bigint, drifting boolean"
MARK = "passed bigint"
#: An observation without a field and so late that it ends all waiting; it gives no flag.
CLOSING = "2261-12-31"


def _advance(batch: DataFrame, batch_id: int, out: str, kept: str, delay: str, window: int) -> int:
    """Take a micro-batch in, write the flags of what the watermark has passed since; the number of late rows."""
    spark = batch.sparkSession

    def folder(name: str, n: int) -> str:
        return f"{kept}/{name}/batch={n}"

    def before(name: str, schema: str) -> DataFrame:
        return spark.read.schema(schema).parquet(folder(name, batch_id - 1)) if batch_id else spark.createDataFrame([], schema)

    def stored(df: DataFrame, name: str, schema: str) -> DataFrame:
        df.write.mode("overwrite").parquet(folder(name, batch_id))
        return spark.read.schema(schema).parquet(folder(name, batch_id))

    mark = before("mark", MARK).first()
    passed = mark["passed"] if mark else None  # milliseconds; NULL before the first time
    wait = spark.sql(f"select unix_millis(timestamp_millis(0) + interval {delay})").first()[0]
    micros = F.unix_micros("ts")

    def earlier(than: int | None):
        """Rows before a time; those without one are neither earlier nor later."""
        return micros < F.lit(than).cast("bigint") * 1000

    arrived = stored(batch, "arrived", ROW)
    newest, late = arrived.agg(F.max(F.unix_millis("ts")), F.count(F.when(earlier(passed), 1))).first()
    known = [x for x in (passed, None if newest is None else newest - wait) if x is not None]
    now = max(known, default=None)
    rows = before("waiting", ROW).unionByName(arrived.where(~F.coalesce(earlier(passed), F.lit(False))))
    complete = F.col("ts").isNull() | F.coalesce(earlier(now), F.lit(False))
    stored(rows.where(~complete), "waiting", ROW)
    ready, tails = rows.where(complete), before("tails", TAIL)
    flags = spark.createDataFrame([], FLAGS)
    if not ready.isEmpty():
        flags, tails = tested(ready, tails, window)
    flags.where(F.col("seq").isNotNull() & ((F.col("field") != "") | F.col("field").isNull())).write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    stored(tails, "tails", TAIL)
    stored(spark.createDataFrame([(now,)], MARK).coalesce(1), "mark", MARK)
    for name in ("arrived", "waiting", "tails", "mark"):  # no micro-batch from here on reads them
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder(name, batch_id - 2))
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return late


def drift_stream(observations: DataFrame, out: str, checkpoint: str, delay: str, trigger: dict | None = None, window: int = cat.DRIFT_WINDOW) -> StreamingQuery:
    """Write the flags of a stream of (field, ts, seq, is_empty) to `out` as Parquet, one folder per micro-batch.

    Rows may come up to `delay` behind the newest one of the micro-batches before.
    """
    rows = observations.select("field", F.col("ts").cast("timestamp").alias("ts"), F.col("seq").cast("bigint").alias("seq"), "is_empty")
    late: dict[int, int] = {}

    def write(batch: DataFrame, batch_id: int) -> None:
        late[batch_id] = _advance(batch, batch_id, out.rstrip("/"), f"{checkpoint.rstrip('/')}/drift", delay, window)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    query = writer.trigger(**(trigger or {"availableNow": True})).start()
    query.late_by_batch = late
    return query


def closing_row(observations: DataFrame) -> DataFrame:
    """One row of the columns of `observations` that moves the watermark past everything; append it to end a stream."""
    values = {"field": F.lit(""), "ts": F.lit(CLOSING).cast("timestamp"), "seq": F.lit(0).cast("bigint"), "is_empty": F.lit(False)}
    row = observations.sparkSession.range(1).select(*[v.alias(k) for k, v in values.items()])
    return row.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in observations.schema if f.name in values])


def late_rows(query: StreamingQuery) -> int:
    """Observations that came too late, over the micro-batches that this query has run."""
    return sum(query.late_by_batch.values())
