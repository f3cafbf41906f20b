"""Balanced contiguous shards: minimax partition of ordered atomic groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import text_or_empty

#: Bits of the text digest that order the groups, of the first blocks, and of each refinement.
UNIT_BITS, BLOCK_BITS, STEP_BITS = 60, 16, 5
#: Row numbers are made inside this many buckets of a shard.
SLOT_BUCKETS = 4096


class Blocks:
    """Consecutive blocks of groups with their sums; some are single groups, the others can be cut."""

    def __init__(self, rows: list[tuple[int, int, int, int, int]]):
        """``rows``: first unit, bits below the block, bytes, bytes of the largest unit, units."""
        self.rows = sorted(rows)
        self.sums = np.array([r[2] for r in self.rows], dtype=np.int64)
        self.ends = np.cumsum(self.sums)
        self.whole = np.array([r[4] == 1 for r in self.rows], dtype=bool)
        self.largest = max((r[3] for r in self.rows), default=0)
        self.total = int(self.ends[-1]) if self.rows else 0

    def cuts(self, capacity: int, shards: int, splitting: bool) -> tuple[list[int], bool]:
        """Greedy ends (in bytes) of at most ``shards`` shards, and whether they hold everything.

        ``splitting``: blocks of several groups may be cut anywhere, which bounds the true cut from
        above; otherwise every block stays whole, which bounds it from below.
        """
        at, out = 0, []
        while at < self.total and len(out) < shards:
            to = min(at + capacity, self.total)
            k = int(np.searchsorted(self.ends, to, side="right"))  # the block that holds the end
            start = int(self.ends[k - 1]) if k else 0
            if k < len(self.rows) and (not splitting or self.whole[k]):
                to = start
            if to <= at:
                return out, False
            out.append(to)
            at = to
        return out, at >= self.total

    def smallest(self, shards: int, splitting: bool) -> int:
        """The smallest capacity under which the greedy check succeeds, by bisection."""
        low = max(self.largest, -(-self.total // shards), 1)
        high = max(self.total, 1)
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, splitting)[1]:
                high = middle
            else:
                low = middle + 1
        return low

    def doubtful(self, low: int, high: int, shards: int) -> list[int]:
        """Blocks between the earliest and the latest place of each cut."""
        late = self.cuts(high, shards, True)[0]
        early, at = [], 0
        for _ in late:  # whole blocks at the lower capacity; an oversized block counts as the place itself
            k = int(np.searchsorted(self.ends, at + low, side="right"))
            at = max(at, int(self.ends[k - 1]) if k else 0)
            early.append(at)
        out: set[int] = set()
        for a, b in zip(early, late):
            first, last = (int(np.searchsorted(self.ends, x, side="right")) for x in (min(a, b), max(a, b)))
            out.update(range(first, min(last + 1, len(self.rows))))
        out.update(int(k) for k in np.nonzero(self.sums > low)[0])
        return [k for k in sorted(out) if not self.whole[k]]


def _blocks(units: DataFrame, below: int) -> list[tuple[int, int, int, int, int]]:
    first = F.shiftleft(F.shiftright("unit", below), below)
    rows = units.groupBy(first.alias("first")).agg(F.sum("bytes"), F.max("bytes"), F.count(F.lit(1))).collect()
    return [(r[0], below, int(r[1]), int(r[2]), r[3]) for r in rows]


def minimax_cuts(units: DataFrame, shards: int) -> list[int]:
    """First units of the shards after the first, for the smallest feasible capacity.

    ``units``: ``unit, bytes``, ordered by ``unit``. Only sums of blocks reach the driver: 65,536
    blocks first, then 32 parts of each block in which a cut of any capacity still in question may
    lie. Lower bound (blocks cut anywhere) and upper bound (blocks whole) meet once these are
    single groups.
    """
    blocks = Blocks(_blocks(units, UNIT_BITS - BLOCK_BITS))
    while True:
        low, high = blocks.smallest(shards, True), blocks.smallest(shards, False)
        open_blocks = blocks.doubtful(low, high, shards) if low < high else []
        if not open_blocks:
            break
        parts = []
        for below in sorted({blocks.rows[k][1] for k in open_blocks}):
            firsts = [blocks.rows[k][0] for k in open_blocks if blocks.rows[k][1] == below]
            inside = units.where(F.shiftleft(F.shiftright("unit", below), below).isin(firsts))
            parts += _blocks(inside, max(below - STEP_BITS, 0))
        gone = set(open_blocks)
        blocks = Blocks([r for k, r in enumerate(blocks.rows) if k not in gone] + parts)
    ends, _ = blocks.cuts(high, shards, False)
    after = [int(np.searchsorted(blocks.ends, e, side="right")) for e in ends[:-1]]
    return [blocks.rows[k][0] for k in after]


def shard_documents(
    docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16
) -> DataFrame:
    """``id, size, text_crc32, law, shard, slot, grown_shard``: shards of nearly equal bytes.

    Documents of equal text form an atomic group. Groups are ordered by their text digest, and the
    order is cut where the smallest feasible capacity fills up. A group over the fair share of what
    is left can't be balanced: it gets a shard of its own (fewer than ``n_shards`` groups can be that
    large), and the capacity is searched for the others. Texts never leave the first scan.

    Null text counts as empty (size ``overhead``), a null id is kept, repeated rows are rows of their own
    with a slot each, other columns are ignored. An empty table gives an empty result; with fewer
    groups than shards some shards are empty.
    """
    text = text_or_empty(text_col)
    rows = docs.select(
        F.col(id_col),
        (F.octet_length(text) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.conv(F.substring(F.sha2(text, 256), 1, UNIT_BITS // 4), 16, 10).cast("long").alias("unit"),
        # Written with the row, so that both later passes see the same bucket.
        F.pmod(F.xxhash64(F.spark_partition_id(), F.col(id_col), text), F.lit(SLOT_BUCKETS)).cast("int").alias("bucket"),
    )
    rows = materialize(rows, "sizes")
    units = materialize(rows.groupBy("unit").agg(F.sum("size").alias("bytes")), "groups")

    total = units.agg(F.sum("bytes")).first()[0] or 0
    giants, left = [], total
    for unit, size in units.orderBy(F.desc("bytes"), "unit").limit(n_shards).collect():
        if size * (n_shards - len(giants)) <= left:
            break
        giants.append(unit)
        left -= size
    rest = units.where(~F.col("unit").isin(giants)) if giants else units
    cuts = minimax_cuts(rest, n_shards - len(giants)) if left else []

    shard = F.lit(len(giants))
    for cut in cuts:
        shard = shard + (F.col("unit") >= F.lit(cut)).cast("int")
    for k, unit in enumerate(giants):
        shard = F.when(F.col("unit") == F.lit(unit), F.lit(k)).otherwise(shard)
    placed = rows.withColumn("shard", shard)

    sizes = placed.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("shard").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("unit", id_col))
    # At most n_shards x SLOT_BUCKETS rows of three numbers: a bounded broadcast.
    numbered = placed.withColumn("at", within).join(
        F.broadcast(starts), (F.col("shard") == F.col("s")) & (F.col("bucket") == F.col("b"))
    )
    return numbered.select(
        id_col,
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("start") + F.col("at") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
