"""Tables, benchmark sinks, CSV metadata and training shards."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize


def save_table(df: DataFrame, name: str, overwrite: bool = False) -> None:
    """Save as a catalog table; without ``overwrite`` an existing table is an error."""
    df.write.mode("overwrite" if overwrite else "errorifexists").saveAsTable(name)


def use_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{place}")
    spark.sql(f"USE {name}")


def drop_table(spark: SparkSession, name: str) -> None:
    """No error when the table is not there yet."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def run_without_writing(df: DataFrame) -> None:
    """Compute every row and column and throw them away."""
    df.write.format("noop").mode("overwrite").save()


def cached(df: DataFrame) -> DataFrame:
    """Persist and compute now. Call ``unpersist`` when done."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    run_without_writing(df)
    return df


def save_files(df: DataFrame, path: str, name_col: str, content_col: str) -> None:
    """One file per row, for formats that Spark has no sink for.

    Tasks write the files themselves, so ``path`` is a folder that all executors have mounted. A file
    appears under its name only when it is complete, so a task that is run again does no harm.
    """
    if "://" in path and not path.startswith("file://"):
        raise ValueError(f"{path} is not a mounted folder")
    folder = path.removeprefix("file://")

    def save(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for row in rows:
            part = f"{folder}/.{uuid.uuid4().hex}"
            with open(part, "wb") as file:
                file.write(row[content_col])
            os.replace(part, f"{folder}/{row[name_col]}")

    df.select(name_col, content_col).foreachPartition(save)


def save_csv(df: DataFrame, path: str) -> None:
    """CSV with a header and no index; white space at the ends of values is kept."""
    df.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def bounded_rows(df: DataFrame, limit: int = 10_000) -> list:
    """Rows on the driver, refused when there are more than ``limit``."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; write a table instead")
    return rows


def save_training_shards(
    df: DataFrame,
    path: str,
    key: str,
    rows_per_shard: int = 100_000,
    split_col: str = "split",
    max_tasks: int = 100_000,
) -> DataFrame:
    """Write ``split=…/shard=…`` Parquet folders of about equal size and return their manifest.

    Shards are hash buckets of the row (key first), so a shard's content does not depend on partitioning, and
    rows that share a key still spread. Any number of splits: the number of shards of each is joined
    to the rows. At most ``max_tasks`` tasks write. The manifest (rows per shard) is counted from the
    written files and saved beside them.
    """
    spark = df.sparkSession
    counts = df.groupBy(split_col).agg(F.count(F.lit(1)).alias("_n"))
    counts = materialize(counts.withColumn("_shards", F.ceil(F.col("_n") / rows_per_shard).cast("long")), "splits")
    total = counts.agg(F.sum("_shards")).first()[0] or 1
    others = [c for c in df.columns if c != key]
    shard = F.pmod(F.xxhash64(key, *others), F.col("_shards")).cast("int")
    (
        df.join(counts.withColumnRenamed(split_col, "_split"), F.col(split_col).eqNullSafe(F.col("_split")))
        .withColumn("shard", shard)
        .select(*df.columns, "shard")
        .repartition(max(1, min(total, max_tasks)), split_col, "shard")
        .write.partitionBy(split_col, "shard")
        .parquet(f"{path}/data")
    )
    written = spark.read.parquet(f"{path}/data")
    written.groupBy(split_col, "shard").agg(F.count(F.lit(1)).alias("n_rows")).write.parquet(
        f"{path}/manifest"
    )
    return spark.read.parquet(f"{path}/manifest")
