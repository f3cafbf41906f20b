"""Every combination of an item with two lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def combinations(items: DataFrame, styles: Sequence[str], colours: Sequence[str]) -> DataFrame:
    """Items times styles times colours, for lists that are arguments, of any length.

    The product is two explodes of constant arrays: no join, no shuffle, and the items stay spread
    as they are. For the values of a table, ``combinations_with``.
    """
    return items.select("*", F.explode(F.lit(list(styles))).alias("style")).select(
        "*", F.explode(F.lit(list(colours))).alias("colour")
    )


def combinations_with(items: DataFrame, values: DataFrame, column: str, rows_per_block: int = 10_000) -> DataFrame:
    """Items times the rows of a one-column table of any length, repeated values included.

    The values are packed into blocks of about ``rows_per_block``; every item goes once to every block, and
    the two meet in an equi-join on the block, of which adaptive execution can split the items' side.
    """
    blocks = max(1, -(-values.count() // rows_per_block))
    # Equal values are numbered, so that even one that fills the table goes to many blocks.
    place = F.row_number().over(Window.partitionBy(column).orderBy(column))
    numbered = values.select(column).withColumn("_n", F.floor((place - 1) / rows_per_block))
    packed = (
        numbered.select(column, F.pmod(F.xxhash64(column) + F.col("_n"), F.lit(blocks)).cast("int").alias("_block"))
        .groupBy("_block")
        .agg(F.array_sort(F.collect_list(F.struct(F.col(column).alias("v")))).alias("_values"))
    )
    tagged = items.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    return (
        tagged.join(packed, "_block")
        .withColumn("_v", F.explode("_values"))
        .withColumn(column, F.col("_v.v"))
        .drop("_block", "_values", "_v")
    )
