"""Session defaults and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Page text is wide; smaller splits keep a task's rows well inside memory.
    "spark.sql.files.maxPartitionBytes": "64m",
    "spark.ui.enabled": "false",
    # Stack capture per column expression makes building large plans several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app: str = "enrichlake", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_base(spark: SparkSession) -> str:
    """The folder that the cluster names in `spark.checkpoint.dir`; a temporary one of this machine for local runs only."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="enrichlake-checkpoint-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that all executors see."""
    return f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` to reliable storage and go on from there: a lost executor costs no more than its unfinished tasks."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint()
