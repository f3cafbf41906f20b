"""Packing token rows into sequences of one length: best fit decreasing over the histogram of lengths."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialize

#: Rows of one length are numbered inside so many buckets, so a length that most rows have spreads over tasks.
BUCKETS = 256


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """``(length, first, count, first_bin, offset)``: where the rows of each length go.

    Lengths descend; each row goes to the fullest bin that still holds it, or to a new one. Rows of one length
    are interchangeable, and so are bins with equal space left, so both are handled by ranges: the ranges
    grow with the number of lengths, never with the number of rows. Rows ``first .. first + count`` of
    a length go to bins ``first_bin ..``, one each, at ``offset``.
    """
    out: list[tuple[int, int, int, int, int]] = []
    space: list[int] = []  # the different amounts of space left, ascending
    open_bins: dict[int, list[tuple[int, int]]] = defaultdict(list)  # by space left: ranges of bins
    n_bins = 0

    def put(left: int, first_bin: int, count: int) -> None:
        if left and count:
            if not open_bins[left]:
                insort(space, left)
            open_bins[left].append((first_bin, count))

    for length in sorted(histogram, reverse=True):
        if not 0 < length <= capacity:
            raise ValueError(f"a row of {length} tokens can't be packed into sequences of {capacity}")
        todo, first = histogram[length], 0
        while todo:
            at = bisect_left(space, length)
            if at < len(space):
                left = space[at]
                begin, bins = open_bins[left].pop()
                if not open_bins[left]:
                    space.pop(at)
            else:
                left, begin, bins = capacity, n_bins, -(-todo // (capacity // length))
                n_bins += bins
            # A bin takes rows of this length until no more fit; the last one may take fewer.
            each = left // length
            whole = min(bins, todo // each)
            rest = min(todo - whole * each, each - 1) if whole < bins else 0
            for rows, count, start in ((each, whole, begin), (rest, 1, begin + whole)):
                for k in range(rows if count else 0):
                    out.append((length, first, count, start, capacity - left + k * length))
                    first += count
                if rows:
                    put(left - rows * length, start, count)
                todo -= rows * count
            used = whole + bool(rest)
            put(left, begin + used, bins - used)
    return out


def number_within(df: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Rows numbered from 0 in their group, by a hash of ``order``; a group of any size spreads over tasks."""
    bucket = F.pmod(F.xxhash64(*order), F.lit(BUCKETS)).cast("int")
    rows = df.withColumn("_b", bucket)
    counts = rows.groupBy(group, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col(group).alias("_g"), F.col("_b").alias("_c"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = F.row_number().over(Window.partitionBy(group, "_b").orderBy(*order)) - 1
    met = rows.withColumn("_r", inside).join(broadcast_if_small(offsets), (F.col(group) == F.col("_g")) & (F.col("_b") == F.col("_c")))
    return met.withColumn(name, (F.col("_o") + F.col("_r")).cast("long")).drop("_b", "_r", "_g", "_c", "_o")


def pack_sequences(df: DataFrame, key: str, ids: str = "input_ids", capacity: int = 2048, pad_id: int = 0) -> DataFrame:
    """``sequence, input_ids, attention_mask, segment_ids, position_ids, keys, lengths``: rows of ``capacity`` tokens.

    Whole rows share a sequence, none is cut. The lengths are counted (at most ``capacity`` numbers reach the
    driver), packed best fit decreasing, and the plan comes back as ranges; rows are numbered per length and
    find their sequence and offset by the range they fall into. ``segment_ids`` number the rows of a sequence
    from 1 (0 is padding) and ``position_ids`` begin anew with each, so attention can be kept inside rows.
    ``keys`` and ``lengths`` tell which rows they are. Rows longer than ``capacity`` are an error: cut or chunk
    them first. Null and empty rows hold nothing and are left out. Rows with equal key and tokens are
    interchangeable.
    """
    spark = df.sparkSession
    rows = df.where(F.size(ids) > 0).select(F.col(key).alias("_k"), F.col(ids).alias("_ids"), F.size(ids).alias("_len"))
    rows = materialize(rows.withColumn("_tag", F.monotonically_increasing_id()), "token-rows")
    longest = rows.agg(F.max("_len")).first()[0] or 0
    if longest > capacity:
        raise ValueError(f"a row of {longest} tokens can't be packed into sequences of {capacity}")
    histogram = {r["_len"]: r["count"] for r in rows.groupBy("_len").count().collect()}
    ranges = spark.createDataFrame(plan(histogram, capacity), "l int, first long, n long, first_bin long, offset int")
    placed = number_within(rows, "_len", ["_k", "_tag"], "_at")
    # The plan is bounded by the number of different lengths.
    placed = placed.join(
        F.broadcast(ranges), (F.col("_len") == F.col("l")) & (F.col("_at") >= F.col("first")) & (F.col("_at") < F.col("first") + F.col("n"))
    )
    placed = placed.select((F.col("first_bin") + F.col("_at") - F.col("first")).alias("sequence"), "offset", "_k", "_ids", "_len")
    # At most `capacity` rows of one token in a group.
    bins = placed.groupBy("sequence").agg(F.array_sort(F.collect_list(F.struct("offset", "_k", "_ids", "_len"))).alias("rows"))
    joined = F.flatten(F.col("rows._ids"))
    missing = F.lit(capacity) - F.size(joined)

    def per_row(body):
        return F.flatten(F.transform("rows", body))

    pad = F.array_repeat(F.lit(0), missing)
    return bins.select(
        "sequence",
        F.concat(joined, F.array_repeat(F.lit(pad_id).cast("int"), missing)).alias("input_ids"),
        F.concat(F.transform(joined, lambda _: F.lit(1)), pad).alias("attention_mask"),
        F.concat(per_row(lambda r, i: F.array_repeat((i + 1).cast("int"), r["_len"])), pad).alias("segment_ids"),
        F.concat(per_row(lambda r: F.sequence(F.lit(0), r["_len"] - 1)), pad).alias("position_ids"),
        F.col("rows._k").alias("keys"),
        F.col("rows._len").alias("lengths"),
    )


def fill_rate(packed: DataFrame) -> float:
    """Share of the places of all sequences that hold tokens."""
    sums = packed.agg(F.sum(F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x)), F.sum(F.size("input_ids"))).first()
    return sums[0] / sums[1] if sums[1] else 1.0
