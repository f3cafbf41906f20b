"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def share(spark: SparkSession, value) -> Broadcast:
    """Broadcast a value whose class is defined in this package.

    Workers look for the package where the driver has found it, unless it was shipped to them.
    """
    environment = spark.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, _ROOT])
    return spark.sparkContext.broadcast(value)


def text_or_empty(text_col: str = "text"):
    """The text as a string column; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def text_key(text_col: str = "text"):
    """A 64-bit key that tells apart rows which share an id but not the text."""
    return F.xxhash64(text_or_empty(text_col))


def runs(batches: Iterator[pa.RecordBatch], key: int = 0, limit: int = 1 << 62) -> Iterator[tuple[list, bool]]:
    """Cut a stream sorted by column ``key`` into whole runs of equal keys.

    Yields ``(columns, open)``: numpy arrays of one or more whole runs, or, where a single run grows
    over ``limit`` rows, pieces of that run with ``open`` set: the part of it that a batch holds, so no run
    that spans many batches is ever held whole.
    """
    kept: list = []  # rows of the run that may go on in the next batch
    streaming = None  # the key of a run that is passed on in pieces
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(new[key]):
            continue
        if streaming is not None:
            end = int(np.searchsorted(new[key] != streaming, True)) if new[key][0] == streaming else 0
            if end:
                yield [c[:end] for c in new], True
            if end == len(new[key]):
                continue
            streaming, new = None, [c[end:] for c in new]
        columns = [np.concatenate([a, b]) for a, b in zip(kept, new)] if kept else new
        last = int(np.searchsorted(columns[key], columns[key][-1]))
        if last:
            yield from _closed([c[:last] for c in columns], key, limit)
        kept = [c[last:] for c in columns]
        if len(kept[key]) > limit:
            streaming = kept[key][0]
            yield kept, True
            kept = []
    if kept:
        yield kept, False


def _closed(columns: list, key: int, limit: int) -> Iterator[tuple[list, bool]]:
    """Whole runs; those over the limit one by one, as pieces of an open run are."""
    starts = np.r_[0, np.flatnonzero(columns[key][1:] != columns[key][:-1]) + 1]
    sizes = np.diff(np.r_[starts, len(columns[key])])
    large = np.repeat(sizes > limit, sizes)
    if not large.all():
        yield [c[~large] for c in columns] if large.any() else columns, False
    for k in np.flatnonzero(sizes > limit):
        yield [c[starts[k] : starts[k] + sizes[k]] for c in columns], True


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the edges ``(a, b)``; the root is the smallest node reachable.

    Alternating large-star and small-star rounds: each round links neighbours to the smallest node
    they know, so stars form in a logarithmic number of rounds. Minima are combined before the
    shuffle, the joins are plain equi-joins that adaptive execution can split, and every round is
    written as a table, so no lineage grows. Null and self edges say nothing and are left out.
    """
    pairs = edges.where(F.col("a") != F.col("b"))
    now = materialize(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    before = None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == before or not state[0]:
            break
        before = tuple(state)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = materialize(large, "large-star")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialize(rest.union(least).distinct(), "small-star")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def ranged(df: DataFrame, *order: str, part: str = "part") -> DataFrame:
    """The rows written in range partitions by ``order`` (nulls first), each with the number of its partition.

    Partition numbers ascend with the order. A tag that no two rows share comes last in the order, so copies
    of one row spread over partitions like any others. The frame is computed once: it is written before Spark
    samples it for the bounds, and again with the partition numbers, which may differ from one run to the next.
    """
    tagged = materialize(df.withColumn("tag", F.monotonically_increasing_id()), "tagged")
    dealt = tagged.repartitionByRange(*[F.col(c).asc() for c in (*order, "tag")])
    return materialize(dealt.withColumn(part, F.spark_partition_id()), "ranged")


def numbered(df: DataFrame, group: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """Rows with their place (from 0) in their group; a group of any size is numbered by many tasks.

    Rows are numbered inside range partitions of (group, order). Of a partition only its first group can have
    begun in an earlier one, so at most one offset per partition is broadcast. Null keys form a group.
    ``tag`` and ``part`` are the helper's own columns and don't come out.
    """
    rows = ranged(df, *group, *order)
    counts = rows.groupBy("part", *group).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("start", F.sum("n").over(earlier)).where("start > 0")
    starts = starts.select(F.col("part").alias("in_part"), *[F.col(g).alias(f"of_{g}") for g in group], "start")
    same = F.col("part") == F.col("in_part")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"of_{g}"))
    within = Window.partitionBy("part", *group).orderBy(*order, "tag")
    placed = rows.withColumn(name, F.row_number().over(within) - 1)
    placed = placed.join(F.broadcast(starts), same, "left")
    placed = placed.withColumn(name, (F.col(name) + F.coalesce("start", F.lit(0))).cast("long"))
    return placed.drop("tag", "part", "in_part", "start", *[f"of_{g}" for g in group])
