"""Session construction and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def get_session(app_name: str = "promptloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume (AQE on, UTC clock)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows of long texts: smaller Arrow batches keep Python workers within their memory.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    On a cluster this is ``spark.checkpoint.dir``, and it is an error not to name one. Only in local mode is a
    temporary folder made and announced to Spark as its checkpoint folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not context.getCheckpointDir() and not re.match(r"local(\[|$)", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="promptloom-"))
    return (configured or context.getCheckpointDir()).rstrip("/")


def run_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never reused, so reruns cannot collide."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _STAGES.append(path)
    return path


_STAGES: list[str] = []


def remove_stages(spark: SparkSession) -> int:
    """Delete what this process has written through ``run_path``; for when all readers are done."""
    removed = 0
    while _STAGES:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGES.pop())
        removed += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return removed


def broadcast_if_small(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Compute once, measure, and mark for broadcast only when the rows fit ``max_bytes`` as JSON."""
    df = materialize(df)
    size = df.agg(F.sum(F.length(F.to_json(F.struct("*"))) + 16)).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage: write the frame as a table in the shared folder and read it back.

    Used where one computed frame feeds several branches. A lost executor then re-reads files
    instead of calling the (possibly sampling) model a second time, readers fetch only the columns
    they need, and Spark knows the size of the result when it plans joins.
    """
    path = run_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
