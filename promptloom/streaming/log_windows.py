"""The inference log as a stateful stream: requests counted once, unsafe rates per window, late rows apart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

WINDOW, DELAY = "1 hour", "2 hours"


def once_each(log: DataFrame, key: str, time: str, delay: str = DELAY) -> DataFrame:
    """A stream in which a request that is delivered again within ``delay`` counts once."""
    return log.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def unsafe_rates(log: DataFrame, time: str, unsafe: str, window: str = WINDOW) -> DataFrame:
    """``start, end, n_requests, n_unsafe, rate`` per event-time window; the same for a stream and for a table."""
    flag = F.coalesce(F.col(unsafe), F.lit(False)).cast("long")
    return (
        log.groupBy(F.window(time, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_requests"), F.sum(flag).alias("n_unsafe"))
        .select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n_requests", "n_unsafe",
                (F.col("n_unsafe") / F.col("n_requests")).alias("rate"))
    )


def _table(spark: SparkSession, path: str) -> DataFrame | None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at) else None


def set_late_apart(log: DataFrame, time: str, path: str, checkpoint: str, delay: str = DELAY) -> StreamingQuery:
    """Writes ``path/on_time`` and ``path/late``: rows older than ``delay`` before the latest of earlier batches are late.

    Spark's own watermark drops such rows without a trace once state has passed them. The bound of each batch is
    written before its rows, so a batch that runs again after a failure is divided as before.
    """

    def divide(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bound = f"{path}/bounds/batch={batch_id}"
        if _table(spark, bound) is None:
            seen = _table(spark, f"{path}/bounds")
            before = seen.where(F.col("batch") < batch_id).agg(F.max("latest").alias("before")) if seen is not None else None
            own = batch.agg(F.max(time).alias("own"))
            both = own.withColumn("before", F.lit(None).cast("timestamp")) if before is None else own.crossJoin(before)  # a row each
            both.select("before", F.greatest("before", "own").alias("latest")).coalesce(1).write.mode("overwrite").parquet(bound)
        before = spark.read.parquet(bound).first()["before"]
        late = F.lit(False) if before is None else F.col(time) < F.lit(before) - F.expr(f"INTERVAL {delay}")
        for name, rows in (("on_time", ~F.coalesce(late, F.lit(False))), ("late", F.coalesce(late, F.lit(False)))):
            batch.where(rows).write.mode("overwrite").parquet(f"{path}/{name}/batch={batch_id}")

    return log.writeStream.foreachBatch(divide).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_latest(windows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Windows as they stand after each micro-batch; ``latest`` reads the last state of each."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        windows.writeStream.outputMode("update").foreachBatch(save).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last state of every window."""
    rows = spark.read.parquet(path)
    others = [c for c in rows.columns if c not in ("start", "batch")]
    newest = rows.groupBy("start").agg(F.max_by(F.struct(*others), "batch").alias("r"))
    return newest.select("start", "r.*")
