"""Running a function once per task slot."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.resource import ResourceProfile
from pyspark.sql import DataFrame, SparkSession


def slots(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def one_row_per_partition(spark: SparkSession, n: int) -> DataFrame:
    """``n`` partitions of one row each."""
    return spark.range(0, n, 1, n)


def run_on_partitions(
    df: DataFrame,
    function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
    n: int,
    barrier: bool = True,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Run ``function`` over ``n`` partitions that start together (``barrier``).

    A barrier stage needs all its tasks at once, so ``n`` must not exceed the cluster's slots.
    ``profile`` asks for executors with given resources, such as GPUs.
    """
    return df.repartition(max(1, n)).mapInPandas(function, schema, barrier=barrier, profile=profile)


def run_on_all_slots(spark: SparkSession, function: Callable[[], str], n: int | None = None) -> DataFrame:
    """Call ``function`` once on each slot and return one ``res`` per call."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            yield pd.DataFrame({"res": [function() for _ in range(len(frame))]})

    return one_row_per_partition(spark, n or slots(spark)).mapInPandas(run, "res string", barrier=True)
