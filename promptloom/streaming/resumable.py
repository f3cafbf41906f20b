"""Inference that resumes: requests arrive as files, answers are committed in slices, a lost job goes on where it was."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _committed(spark: SparkSession, path: str) -> list[str]:
    """Folders of slices whose job has been committed, in every batch."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/slice=*/_SUCCESS")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    return sorted(f.getPath().getParent().toString() for f in found)


def answers(spark: SparkSession, path: str) -> DataFrame | None:
    """All committed answers; what a lost job has left behind is not read. None where nothing is answered yet."""
    folders = _committed(spark, path)
    return spark.read.parquet(*folders) if folders else None


def infer_new_rows(
    requests: DataFrame, path: str, checkpoint: str, answer: Callable[[DataFrame], DataFrame], key: str, slices: int = 8
) -> StreamingQuery:
    """Answer everything that has arrived and not been answered, then stop.

    ``requests`` is a stream of files, ``answer`` adds a model's columns to a frame of requests. A micro-batch is
    answered in ``slices`` by a hash of the key, each written and committed by itself; the checkpoint
    remembers batches. After a lost job the next run finds the batch it was in, skips the slices that were
    committed, and calls the model for the others only. A key that has been answered in an earlier batch, or comes
    twice, is answered once. Null keys are not answered.
    """

    def commit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{path}/batch={batch_id}"
        done = [f for f in _committed(spark, path) if f"/batch={batch_id}/" not in f]
        todo = batch.where(F.col(key).isNotNull()).dropDuplicates([key])
        if done:
            todo = todo.join(spark.read.parquet(*done).select(key), key, "left_anti")
        for n in range(slices):
            part = f"{folder}/slice={n}"
            if not _exists(spark, f"{part}/_SUCCESS"):
                answer(todo.where(F.pmod(F.xxhash64(key), F.lit(slices)) == n)).write.mode("overwrite").parquet(part)

    return (
        requests.writeStream.foreachBatch(commit).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
