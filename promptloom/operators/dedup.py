"""Union and duplicate removal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, nulls equal, in one pass over ``df``.

    One pass, so that a frame that answers differently each time (sampled generations) can't lose or keep
    rows by mistake. Copies are combined before the shuffle, so a hot row does not skew it.
    """
    return df.dropDuplicates()


def unique_values(df: DataFrame, column: str | Column) -> DataFrame:
    return df.select(column).distinct()


def stack_splits(*frames: DataFrame) -> DataFrame:
    """Union all by position, for splits of one source."""
    return reduce(DataFrame.union, frames)


def stack_sources(*frames: DataFrame) -> DataFrame:
    """Union all by name, for sources brought to the same columns."""
    return reduce(DataFrame.unionByName, frames)


def instruction_dataset(*sources: DataFrame, end_mark: str) -> DataFrame:
    """Merge ``(prompt, response)`` sources, drop duplicate pairs, close every response."""
    pairs = stack_sources(*[s.select("prompt", "response") for s in sources])
    return drop_duplicate_rows(pairs).withColumn("response", F.concat("response", F.lit(end_mark)))
