"""SimHash near-duplicates by meeting in the middle of a Hamming ball."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import components, runs, text_key, text_or_empty

#: Words follow one another in a 64-bit fingerprint of four blocks; one block is left out at a time.
BLOCKS, BLOCK_WIDTH = 4, 16
#: Buckets over this many fingerprints are linked through whole balls instead of by comparison.
BUCKET_LIMIT = 2_000
#: Shingle hashes that are turned into bits at a time.
HASHES_AT_ONCE = 16_384


def fingerprint(text: bytes, n: int = 3) -> int:
    """Majority bits of the XXH64 values (seed 42) of a text's word shingles; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= n:
        return xxhash.xxh64_intdigest(joined, 42)
    digest = xxhash.xxh64_intdigest
    ends = list(accumulate((len(w) + 1 for w in words)))
    hashes = [digest(joined[a : b - 1], 42) for a, b in zip([0, *ends], ends[n - 1 :])]
    votes = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), HASHES_AT_ONCE):
        part = np.array(hashes[at : at + HASHES_AT_ONCE], dtype="<u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, n: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, key, fp``: one row per row of ``docs``; ``fp`` is the fingerprint as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.fromiter((fingerprint(t.as_py(), n) for t in batch.column(2)), dtype=np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(values.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "key", "fp"])

    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField(id_col, id_type), T.StructField("key", T.LongType()), T.StructField("fp", T.LongType())]
    )
    rows = docs.select(
        F.col(id_col), text_key(text_col).alias("key"), text_or_empty(text_col).cast("binary").alias("text")
    )
    return rows.mapInArrow(compute, schema)


def flips(bits: list[int], radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of the given bits, fewest first."""
    masks = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(bits, r)]
    return np.array(masks, dtype=np.uint64)


def _kept_masks(max_distance: int) -> list[tuple[int, np.ndarray]]:
    """For each block left out: what is kept, and the flips of half the distance that can remain.

    Of ``max_distance`` differing bits some block holds at least a quarter. Without that block,
    two fingerprints differ in at most the rest, and meet in the middle of that.
    """
    remaining = max_distance - -(-max_distance // BLOCKS)
    out = []
    for block in range(BLOCKS):
        gone = range(block * BLOCK_WIDTH, (block + 1) * BLOCK_WIDTH)
        bits = [b for b in range(64) if b not in gone]
        out.append((sum(1 << b for b in bits), flips(bits, -(-remaining // 2))))
    return out


def _emit(masks: list[tuple[int, np.ndarray]]):
    """``(variant, fp)`` for every fingerprint of a batch."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 2_000):
                some = fps[at : at + 2_000]
                for keep, flip in masks:
                    variants = (some.view(np.uint64) & np.uint64(keep))[:, None] ^ flip[None, :]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(variants.view(np.int64).ravel()), pa.array(np.repeat(some, len(flip)))],
                        names=["variant", "fp"],
                    )

    return emit


def _local_links(fps: np.ndarray, max_distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint of a bucket with the first one it is connected to inside the bucket."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= max_distance
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(fps))
    return fps[moved], fps[label[moved]]


def _verify(max_distance: int, limit: int):
    """Buckets of a stream sorted by variant: ``(a, b, crowded)`` links, or members of crowded buckets."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (keys, fps), crowded in runs(batches, 0, limit):
            if crowded:
                out = [fps, fps]
            else:
                starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                sizes = np.diff(np.r_[starts, len(keys)])
                pairs = starts[sizes == 2]
                a, b = fps[pairs], fps[pairs + 1]
                near = np.bitwise_count(a.view(np.uint64) ^ b.view(np.uint64)) <= max_distance
                found = [(a[near], b[near])]
                for start, size in zip(starts[sizes > 2], sizes[sizes > 2]):
                    x, y = _local_links(fps[start : start + size].view(np.uint64), max_distance)
                    found.append((x.view(np.int64), y.view(np.int64)))
                out = [np.concatenate(x) for x in zip(*found)]
            if len(out[0]):
                flags = pa.array(np.full(len(out[0]), crowded))
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), flags], names=["a", "b", "crowded"])

    return verify


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a stream sorted by (variant, far, fp): everybody at a variant linked to its nearest holder.

    Whoever is within the smaller half of the distance from a variant is within the whole distance of
    everybody within the larger half; so one star per variant links all without comparing pairs.
    """
    center = (None, None)
    for batch in batches:
        keys, far, fps = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        first = np.r_[True, keys[1:] != keys[:-1]]
        starts = np.flatnonzero(first)
        which = np.cumsum(first) - 1
        hub, usable = fps[starts].copy(), ~far[starts]
        if len(keys) and keys[0] == center[0]:
            hub[0], usable[0] = center[1][0], center[1][1]
        if len(keys):
            center = (keys[-1], (hub[-1], usable[-1]))
        a, b = hub[which], fps
        good = usable[which] & (a != b)
        yield pa.RecordBatch.from_arrays([pa.array(b[good]), pa.array(a[good])], names=["a", "b"])


def _balls(max_distance: int):
    """``(variant, far, fp)`` over whole fingerprints; far: beyond the smaller half of the distance."""
    flip = flips(list(range(64)), -(-max_distance // 2))
    far = np.bitwise_count(flip) > max_distance // 2

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy()
            for at in range(0, len(fps), 200):
                some = fps[at : at + 200]
                variants = some.view(np.uint64)[:, None] ^ flip[None, :]
                columns = [variants.view(np.int64).ravel(), np.tile(far, len(some)), np.repeat(some, len(flip))]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["variant", "far", "fp"])

    return emit


def links(distinct: DataFrame, max_distance: int = 3, limit: int = BUCKET_LIMIT) -> DataFrame:
    """``(a, b)``: verified links between distinct fingerprints (column ``fp``), enough to connect every group.

    Every fingerprint emits its variants, the shuffle brings together those that share one, and a
    bucket passes on a spanning forest of the pairs that pass the check on all 64 bits. The members of a
    bucket over ``limit`` are linked exactly through their whole balls, with no comparison of pairs.
    """
    met = (
        distinct.select("fp")
        .mapInArrow(_emit(_kept_masks(max_distance)), "variant long, fp long")
        .repartition("variant")
        .sortWithinPartitions("variant", "fp")
        .mapInArrow(_verify(max_distance, limit), "a long, b long, crowded boolean")
        .distinct()
    )
    met = materialize(met, "links")
    stars = (
        met.where("crowded")
        .select(F.col("a").alias("fp"))
        .mapInArrow(_balls(max_distance), "variant long, far boolean, fp long")
        .repartition("variant")
        .sortWithinPartitions("variant", "far", "fp")
        .mapInArrow(_stars, "a long, b long")
    )
    return met.where("not crowded").select("a", "b").union(stars)


def near_duplicates(
    docs: DataFrame, n: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text",
    limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """``id, key, fp, fingerprint, component_id, keep_key``: one row per document.

    ``component_id`` is the smallest id reachable over links of at most ``max_distance`` bits; texts
    without words have fingerprint 0 and are linked like any other. Only distinct fingerprints are
    compared, and equal ones never meet as pairs.

    A null text counts as empty. Null ids sort last: a component of null ids has a null id. Repeated
    rows share everything. ``(component_id, keep_key)`` names one text of each component, of the
    smallest id, ``key`` being a 64-bit hash of the text. An empty table gives an empty result.
    """
    rows = materialize(fingerprints(docs, n, id_col, text_col), "fingerprints")
    first = F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.col("key").alias("key")))
    distinct = materialize(rows.groupBy("fp").agg(first.alias("first")), "distinct")
    roots = components(links(distinct, max_distance, limit))
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    named = materialize(named, "components")
    chosen = named.groupBy("root").agg(F.min("first").alias("chosen"))
    of_fp = named.select("fp", "root").join(chosen, "root").select("fp", "chosen")
    return rows.join(of_fp, "fp").select(
        id_col,
        "key",
        "fp",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("chosen.id").alias("component_id"),
        F.col("chosen.key").alias("keep_key"),
    )


def drop_near_duplicates(
    docs: DataFrame, n: int = 3, max_distance: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: the one of the smallest id.

    Copies of the kept row itself are dropped too. All columns are kept.
    """
    found = near_duplicates(docs, n, max_distance, id_col, text_col)
    kept = materialize(
        found.where(F.col(id_col).eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("keep_key")))
        .select(F.col(id_col).alias("kept_id"), F.col("key").alias("kept_key"))
        .distinct(),
        "kept",
    )
    packed = docs.select(F.struct("*").alias("row"), F.col(id_col).alias("id"), text_key(text_col).alias("key"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key"))
    return packed.join(kept, same, "left_semi").dropDuplicates(["id", "key"]).select("row.*")
