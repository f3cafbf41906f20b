"""Tables and named datasets as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import col
from ..operators.sample import train_test_split


#: Scan partitions from which an input is large enough to be left as it is.
TINY = 16
#: Bytes of images, and images, that a task hands on at a time.
CONTENT_AT_ONCE, FILES_AT_ONCE = 16 << 20, 2_000


def balanced(df: DataFrame) -> DataFrame:
    """Spread a tiny input over all task slots before heavy per-row work.

    Only an input that the scan splits into fewer than ``TINY`` partitions, and fewer than there are slots,
    is dealt out anew: a single file with one row group can't be split by the scan. Anything larger keeps the
    scan's own splits, so no text is shuffled at scale.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < min(TINY, slots) else df


def from_rows(spark: SparkSession, rows: Iterable, schema: T.StructType) -> DataFrame:
    """A small list of rows as a table; the schema is stated, not inferred."""
    return spark.createDataFrame(list(rows), schema)


def load_dataset(
    spark: SparkSession, path_or_name: str, format: str = "parquet", schema: T.StructType | None = None, **options
) -> DataFrame:
    """A path that starts with ``/`` (or names a file system) is read, any other name is a table."""
    if path_or_name.startswith("/") or "://" in path_or_name:
        reader = spark.read.format(format).options(**options)
        return (reader.schema(schema) if schema else reader).load(path_or_name)
    return spark.table(path_or_name)


def tagged(splits: dict[str, DataFrame], split_col: str = "split") -> DataFrame:
    """Named splits as one table with a split column."""
    frames = [df.withColumn(split_col, F.lit(name)) for name, df in splits.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def load_split(df: DataFrame, split: str, source: str, split_col: str = "split") -> DataFrame:
    """The rows of one split; a split without rows is a configuration error."""
    rows = df.where(F.col(split_col) == split)
    if rows.isEmpty():
        raise ValueError(f"{source} has no rows in a split named {split}")
    return rows.drop(split_col)


def load_or_split(
    df: DataFrame,
    source: str,
    key: str,
    train: str = "train",
    test: str = "test",
    test_size: float | int = 0.2,
    seed: int = 68,
    split_col: str = "split",
) -> tuple[DataFrame, DataFrame]:
    """The named splits where the dataset has them, else a new exact split."""
    if split_col in df.columns:
        return load_split(df, train, source, split_col), load_split(df, test, source, split_col)
    parts = train_test_split(df, key, test_size, seed, split_col)
    return (
        parts.where(F.col(split_col) == "train").drop(split_col),
        parts.where(F.col(split_col) == "test").drop(split_col),
    )


def flatten(df: DataFrame, struct_col: str) -> DataFrame:
    """The fields of a nested record as columns."""
    return df.select(f"{struct_col}.*")


def flatten_json(df: DataFrame, json_col: str, schema: T.StructType, keep: list[str] | None = None) -> DataFrame:
    """The fields of a JSON text as columns."""
    parsed = df.select(*(keep or []), F.from_json(json_col, schema).alias("_j"))
    return parsed.select(*(keep or []), "_j.*")


def first_column(df: DataFrame) -> Column:
    """The single-column model contract: the first column is the text."""
    return F.col(df.columns[0])


def _mounted(spark: SparkSession, path: str) -> str | None:
    """A path as a folder of the local file system (mounted on all executors), or None for any other store."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at)
    return whole.toUri().getPath() if whole.toUri().getScheme() == "file" else None


def image_folder(spark: SparkSession, path: str, captions: str = "metadata.csv", suffix: str = "*.png") -> DataFrame:
    """``file_name, text, path, content``: images of a folder with the captions of its metadata file.

    In a mounted folder tasks open the files that the captions name: any number of them, none listed by the driver.
    Elsewhere Spark lists the folder and joins it to the captions.
    """
    schema = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("text", T.StringType())])
    table = spark.read.csv(f"{path}/{captions}", schema=schema, header=True, multiLine=True, escape='"')
    folder = _mounted(spark, path)
    if folder is None or any(c in path + suffix.replace("*", "") for c in "*?[]{}\\"):
        images = spark.read.format("binaryFile").option("pathGlobFilter", suffix).load(path)
        named = images.select(F.substring_index("path", "/", -1).alias("file_name"), "path", "content")
        return named.join(table, "file_name")

    def opened(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Hidden names are no images to Spark either.
                if name is None or "/" in name or name[:1] in ("", ".", "_") or not fnmatchcase(name, suffix):
                    continue
                try:
                    with open(f"{folder}/{name}", "rb") as file:
                        content = file.read()
                except (FileNotFoundError, IsADirectoryError):
                    continue
                found.append((name, text, f"file:{folder}/{name}", content))
                size += len(content)
                if size >= CONTENT_AT_ONCE or len(found) >= FILES_AT_ONCE:
                    yield _image_rows(found)
                    found, size = [], 0
        if found:
            yield _image_rows(found)

    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return table.repartition(tasks, "file_name").mapInArrow(opened, "file_name string, text string, path string, content binary")


def _image_rows(found: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.string(), pa.string(), pa.binary())
    columns = [pa.array(c, t) for c, t in zip(zip(*found), types)]
    return pa.RecordBatch.from_arrays(columns, names=["file_name", "text", "path", "content"])


def messages_column(c: Column | str, is_json: bool) -> Column:
    from ..functions.chat import parse_messages

    return parse_messages(c) if is_json else col(c)
