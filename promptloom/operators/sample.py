"""Exact, repeatable samples, splits, orders and row ids.

A plain ``orderBy(hash).limit(n)`` sends up to ``n`` whole rows of *every* task to one reducer.
Here only a histogram of hash prefixes is gathered (at most 65,536 rows) to find the hash of the
n-th row; the sample or split is then a filter on the hash, with no shuffle of the data at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_HEX = 64  # characters of a SHA-256 digest
_STEP = 4  # prefix characters added per pass: 16^4 buckets
_FINE = 100_000  # a bucket this small is listed hash by hash
KEYS_AT_ONCE = 1_000_000  # keys that one task sorts


def order_hash(key: str | list[str], seed: int | None = None) -> Column:
    """SHA-256 of the key columns (and a seed): the pseudo-random order of the rows."""
    keys = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    text = parts[0] if len(parts) == 1 else F.concat_ws("\x1f", *parts)
    if seed is not None:
        text = F.concat(text, F.lit(f"\x1f{seed}"))
    return F.sha2(text, 256)


def content_hash(df: DataFrame) -> Column:
    """SHA-256 of a whole row as JSON: nulls, empty texts and separators inside values stay apart."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)


@dataclass(frozen=True)
class Cut:
    """Rows with a hash below ``value`` are in; of the ``ties`` at ``value``, ``wanted`` are."""

    value: str
    wanted: int
    ties: int


def find_cut(df: DataFrame, hash_col: Column, n: int | Callable[[int], int]) -> Cut | None:
    """The hash of the ``n``-th row in hash order; None when the table has no more than ``n`` rows.

    ``n`` may be a function of the row count, which the first pass knows anyway.
    Each pass counts rows per prefix within the bucket that holds the n-th row, which narrows
    the bucket 65,536-fold. Only the key columns are read.
    """
    hashes = df.select(hash_col.alias("h"))
    prefix, left = "", n if isinstance(n, int) else 0
    while len(prefix) < _HEX:
        level = hashes.where(F.col("h").startswith(prefix)) if prefix else hashes
        bucket = F.substring("h", len(prefix) + 1, _STEP).alias("p")
        counts = level.groupBy(bucket).agg(F.count(F.lit(1)).alias("count"), F.max("h").alias("top")).collect()
        if not prefix:
            total = sum(r["count"] for r in counts)
            left = n if isinstance(n, int) else n(total)
            if total <= left:
                return None
        for row in sorted(counts, key=lambda r: r["p"]):
            if left <= row["count"]:
                break
            left -= row["count"]
        if left == row["count"]:
            # The whole bucket is in (always so when it holds one row).
            return Cut(row["top"], left, left)
        prefix, size = prefix + row["p"], row["count"]
        if size <= _FINE and len(prefix) < _HEX:
            listed = hashes.where(F.col("h").startswith(prefix)).groupBy("h").count().collect()
            for row in sorted(listed, key=lambda r: r["h"]):
                if left <= row["count"]:
                    return Cut(row["h"], left, row["count"])
                left -= row["count"]
    return Cut(prefix, left, size)


def _halves(df: DataFrame, order: Column, n: int, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows in hash order, and the others. ``whole``: the hash covers whole rows."""
    if n <= 0:
        return df.where(F.lit(False)), df
    cut = find_cut(df, order, n)
    return (df, df.where(F.lit(False))) if cut is None else _divide(df, order, cut, whole)


def _divide(df: DataFrame, order: Column, cut: Cut, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    if cut.wanted == cut.ties:
        return df.where(order <= cut.value), df.where(order > cut.value)
    first, rest = df.where(order < cut.value), df.where(order > cut.value)
    tied = df.where(order == cut.value)
    if not whole:
        # Rows that share a key: order them by their whole content.
        tie_first, tie_rest = _halves(tied, content_hash(df), cut.wanted, whole=True)
    else:
        tie_first, tie_rest = _copies(tied, cut.wanted), _copies(tied, cut.ties - cut.wanted)
    return first.unionByName(tie_first), rest.unionByName(tie_rest)


def _copies(identical: DataFrame, n: int, block: int = 100_000, max_tasks: int = 10_000) -> DataFrame:
    """``n`` copies of the row that ``identical`` repeats.

    Copies are interchangeable, so one is kept and multiplied in two steps: blocks of ``block`` copies are
    dealt out to at most ``max_tasks`` tasks.
    """
    blocks = math.ceil(n / block)
    start = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("_block")
    spread = identical.limit(1).select("*", start).repartition(max(1, min(blocks, max_tasks)), "_block")
    size = F.when(F.col("_block") == blocks - 1, F.lit(n - block * (blocks - 1))).otherwise(F.lit(block))
    copies = spread.select(*identical.columns, F.explode(F.sequence(F.lit(1), size)).alias("_copy"))
    return copies.drop("_copy")


def sample_rows(
    df: DataFrame, key: str | list[str], n: int | Callable[[int], int], seed: int | None = None
) -> DataFrame:
    """Exactly ``n`` rows (all when there are fewer): the first in order of the key's SHA-256.

    ``n`` may be a function of the row count, for a sample that grows with the table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order = order_hash(keys, seed)
    if isinstance(n, int) and n <= 0:
        return df.where(F.lit(False))
    cut = find_cut(df, order, n)
    return df if cut is None else _divide(df, order, cut)[0]


def train_test_split(
    df: DataFrame,
    key: str | list[str],
    test_size: float | int = 0.2,
    seed: int | None = 68,
    split_col: str = "split",
) -> DataFrame:
    """Tag every row ``train`` or ``test``; ``test_size`` is a row count, or a fraction rounded up.

    The split depends on keys and seed only, not on partitioning, and the sizes are exact.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if isinstance(test_size, float):
        if not 0 < test_size < 1:
            raise ValueError(f"a fractional test_size lies between 0 and 1, got {test_size}")
        # Through 12 decimals, so that 0.05 * 100 is 5 and not the 6 its binary error would give.
        n_test = lambda total: math.ceil(round(test_size * total, 12))
    elif test_size <= 0:
        return df.withColumn(split_col, F.lit("train"))
    else:
        n_test = test_size
    order = order_hash(keys, seed)
    cut = find_cut(df, order, n_test)
    if cut is None:
        return df.withColumn(split_col, F.lit("test"))
    if cut.wanted == cut.ties:
        return df.withColumn(split_col, F.when(order <= cut.value, "test").otherwise("train"))
    test, train = _divide(df, order, cut)
    return test.withColumn(split_col, F.lit("test")).unionByName(
        train.withColumn(split_col, F.lit("train"))
    )


def shuffled(df: DataFrame, key: str | list[str], seed: int = 42) -> DataFrame:
    """The whole table in a seeded random order that does not depend on partitioning."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(order_hash(keys, seed), *keys)


def with_position(
    df: DataFrame, key: str | list[str], name: str = "position", seed: int | None = None
) -> DataFrame:
    """Consecutive ids 0..N-1 in hash order of a unique key, without a one-partition window.

    Rows are numbered inside 65,536 hash buckets and shifted by the running count of the buckets
    before; that offset table is bounded by the number of buckets, so it is broadcast.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hashed = df.withColumn("_h", order_hash(keys, seed)).withColumn("_b", F.substring("_h", 1, _STEP))
    counts = df.select(F.substring(order_hash(keys, seed), 1, _STEP).alias("_b")).groupBy("_b").count()
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_b", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy("_h", *keys)) - 1
    return (
        hashed.withColumn("_r", inside)
        .join(F.broadcast(offsets), "_b")
        .withColumn(name, (F.col("_offset") + F.col("_r")).cast("bigint"))
        .drop("_b", "_h", "_r", "_offset")
    )


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """Exactly the first ``n`` rows by an order key (a named split's slice ``[:n]``).

    Keys alone are dealt out by range and counted per range; the n-th key is looked for in the one range
    that holds it, and the rows come from a filter that reaches the scan. Rows that tie at the last key
    are taken in order of their whole content. Null keys come last.
    """
    if n <= 0:
        return df.where(F.lit(False))
    ranged = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k")).repartitionByRange("k")
    ranges = materialize(ranged.withColumn("p", F.spark_partition_id()), "ranges")
    below = 0
    for row in sorted(ranges.groupBy("p").count().collect()):
        if below + row["count"] >= n:
            break
        below += row["count"]
    else:
        known = df.where(F.col(key).isNotNull())
        return known.unionByName(_halves(df.where(F.col(key).isNull()), content_hash(df), n - below, whole=True)[0])
    last = _nth_key(ranges.where(F.col("p") == row["p"]).select("k"), n - below, row["count"])
    before = df.where(F.col(key) < F.lit(last))
    counted = ranges.agg(F.sum((F.col("k") < F.lit(last)).cast("int")), F.sum((F.col("k") == F.lit(last)).cast("int"))).first()
    if counted[0] + counted[1] == n:
        return df.where(F.col(key) <= F.lit(last))
    return before.unionByName(_halves(df.where(F.col(key) == F.lit(last)), content_hash(df), n - counted[0], whole=True)[0])


def _nth_key(keys: DataFrame, n: int, size: int, at_once: int | None = None):
    """The ``n``-th smallest of the keys; more than ``at_once`` are dealt out by range again, so no task sorts more."""
    at_once = at_once or KEYS_AT_ONCE
    while size > at_once:
        # The smallest key first: it may be one that most rows share, which no range divides.
        low = keys.agg(F.min("k")).first()[0]
        equal = keys.where(F.col("k") == F.lit(low)).count()
        if n <= equal:
            return low
        keys, n, size = keys.where(F.col("k") > F.lit(low)), n - equal, size - equal
        parts = max(2, -(-2 * size // at_once))
        keys = materialize(keys.repartitionByRange(parts, "k").withColumn("p", F.spark_partition_id()), "ranges")
        for row in sorted(keys.groupBy("p").count().collect()):
            if row["count"] >= n:
                break
            n -= row["count"]
        keys, size = keys.where(F.col("p") == row["p"]).select("k"), row["count"]
    return keys.orderBy("k").limit(n).agg(F.max("k")).first()[0]


def spread(df: DataFrame, n: int) -> DataFrame:
    """Round-robin over ``n`` partitions, at least one (so "workers minus one" works on one machine)."""
    return df.repartition(max(1, n))


def grouped_by_length(df: DataFrame, length_col: str, n: int, key: str) -> DataFrame:
    """Rows of similar length side by side, so that padded batches waste little.

    The key is part of the range, so a length shared by very many rows still spreads over tasks.
    """
    by = [F.col(length_col), F.xxhash64(key)]
    return df.repartitionByRange(max(1, n), *by).sortWithinPartitions(*by)


def preview(df: DataFrame, order: str | list[str], n: int) -> DataFrame:
    """The first ``n`` rows for looking at."""
    return df.orderBy(order).limit(n)
