"""The inference log: requests arrive as files, are judged and masked, and are appended to a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions import chat, pii
from ..operators import guard
from ..operators.generate import Loader


def read_requests(
    spark: SparkSession, folder: str, schema: T.StructType, files: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """New request files of a folder as a stream; where ``files`` names a folder inside it, that folder's files.

    A table written by Spark is such a folder, and a stream lists neither it by a pattern of file names nor its files.
    """
    inside = spark._jvm.org.apache.hadoop.fs.Path(folder, files)
    is_folder = "*" not in files and inside.getFileSystem(spark._jsc.hadoopConfiguration()).isDirectory(inside)
    folder, files = (f"{folder}/{files}", "*") if is_folder else (folder, files)
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", files)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def judged(requests: DataFrame, role: str, text: str, loader: Loader, taxonomy: Column) -> DataFrame:
    """Each request judged as a one-message chat, its text masked. Stateless, so no watermark.

    ``status`` tells where the guard gave no verdict.
    """
    message = F.array(F.struct(F.col(role).alias("role"), F.col(text).alias("content")))
    prompt = chat.moderation_prompt(message, taxonomy)
    scored = guard.score(requests, prompt, loader, taxonomy)
    return scored.withColumn(text, pii.mask_pii(text)).drop("verdict", "error")


def append(log: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything that has arrived, then stop. File sink and checkpoint make it exactly-once."""
    return (
        log.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


NOT_JUDGED = "not judged"


def monitor(log: DataFrame) -> DataFrame:
    """Messages that did not pass, per violated code; those without a verdict are a class of their own."""
    unknown = F.col("is_safe").isNull()
    return (
        log.where(unknown | ~F.col("is_safe"))
        .groupBy(
            F.when(unknown, NOT_JUDGED).otherwise(F.col("code")).alias("code"),
            F.when(unknown, F.col("status")).otherwise(F.col("category")).alias("category"),
        )
        .agg(F.count(F.lit(1)).alias("n_messages"))
    )
