"""The page gate inside Structured Streaming.

Triage, extraction and row checks are stateless, so they run unchanged on a
stream. Drift looks across runs and stays a batch job over the history that the
stream appends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..plans.pages import gate_pages, observations
from ..sources.writers import dead_letters


def gate_stream(pages: DataFrame, out: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Gate a streaming page table into `out/rows`, `out/history` and `out/dead_letter`.

    Each micro-batch writes its rows first and serves the other sinks from there,
    so a page is extracted once. Every sink has one folder per batch, which a batch
    that is run again replaces.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        def folder(sink: str) -> str:
            return f"{out}/{sink}/batch_id={batch_id}"

        gate_pages(batch).write.mode("overwrite").parquet(folder("rows"))
        rows = batch.sparkSession.read.parquet(folder("rows"))
        observations(rows, "page_id").drop("_field").write.mode("overwrite").parquet(folder("history"))
        dead_letters(rows, "page").write.mode("overwrite").json(folder("dead_letter"))

    writer = pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
