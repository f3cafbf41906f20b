"""Embedding, vector stores and exact nearest-neighbour search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors
from ..functions.text import col
from ..session import broadcast_if_small, materialize, run_path

# Queries up to this size travel to every task; larger sets take the tiled path.
BROADCAST_BYTES = 64 << 20
# Scores held at once by one task: 32 MB of doubles.
BLOCK_SCORES = 4_000_000
# Rows and columns of one tile of a similarity matrix: 4 million scores, 32 MB.
TILE_ROWS = 2_000
# Queries scored at a time.
QUERY_SLAB = 4096
# Scores are compared after rounding: float32 embeddings carry no more digits, and equal rounded
# scores are ordered by id, so results do not depend on the order of additions.
DIGITS = 6
# Parts of a query's candidates that are merged on their own before the last step.
MERGE_PARTS = 32


def embed(
    df: DataFrame,
    text: str | Column,
    out: str,
    loader: Callable[[], Callable[[list[str]], Sequence]],
    normalized: bool = False,
) -> DataFrame:
    """Add an embedding column; ``loader`` gives ``encode(texts)`` once per task."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = loader()
        for texts in batches:
            rows = [np.asarray(v, dtype=np.float32) for v in model(texts.tolist())]
            yield pd.Series(rows, index=texts.index, dtype=object)

    frame = df.withColumn(out, encode(col(text)))
    return frame.withColumn(out, vectors.normalize(out)) if normalized else frame


def documents(df: DataFrame, text: str) -> DataFrame:
    """``page_content`` and all other columns as one ``metadata`` struct."""
    others = [c for c in df.columns if c != text]
    return df.select(F.col(text).alias("page_content"), F.struct(*others).alias("metadata"))


def save_store(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Persist chunks, metadata and vectors as a Parquet vector store."""
    df.write.mode(mode).parquet(path)


def load_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def metadata_filter(df: DataFrame, wanted: dict | None) -> DataFrame:
    """All equalities must hold; applied before the search, so it reaches the scan."""
    for name, value in (wanted or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    return df


# --- scoring kernels, shared by the broadcast and the tiled path ---------------------------------


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one in double precision; zero rows stay zero, so they score 0."""
    matrix = matrix.astype(np.float64)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(length == 0, 1.0, length)


def as_matrix(column) -> np.ndarray:
    """Arrow list column to a matrix; vectors of different length are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    widths = np.unique(np.diff(column.offsets.to_numpy()))
    if len(widths) > 1:
        raise ValueError(f"vectors differ in length: {widths.tolist()}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def keep_best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int):
    """The ``k`` best per query, higher score first, then lower id."""
    order = np.lexsort((ids, -scores, query))
    query, ids, scores = query[order], ids[order], scores[order]
    first = np.r_[0, np.flatnonzero(np.diff(query)) + 1] if len(query) else np.empty(0, int)
    sizes = np.diff(np.r_[first, len(query)])
    rank = np.arange(len(query)) - np.repeat(first, sizes)
    kept = rank < k
    return query[kept], ids[kept], scores[kept]


class RunningBest:
    """The best ``k`` items of each query over the blocks of unit rows seen so far."""

    def __init__(self, queries: np.ndarray, k: int, digits: int):
        self.slabs = [queries[a : a + QUERY_SLAB] for a in range(0, len(queries), QUERY_SLAB)]
        self.k, self.digits = k, digits
        self.found: list = [None] * len(self.slabs)
        # Scores a new item must reach: the k-th best of each query, or nothing yet.
        self.floors = [np.full(len(slab), -np.inf) for slab in self.slabs]
        self.block_rows = max(1, BLOCK_SCORES // max(1, min(len(queries), QUERY_SLAB)))

    def add(self, ids: np.ndarray, rows: np.ndarray) -> None:
        for start in range(0, len(rows), self.block_rows):
            block = slice(start, start + self.block_rows)
            for n in range(len(self.slabs)):
                self._add_block(n, ids[block], rows[block])

    def _add_block(self, n: int, ids: np.ndarray, rows: np.ndarray) -> None:
        k, floor = self.k, self.floors[n]
        scores = rows @ self.slabs[n].T
        if len(rows) > k and np.isinf(floor).any():
            # Not yet full: at least the k best of this block.
            floor = np.maximum(floor, np.partition(scores, len(rows) - k, axis=0)[len(rows) - k])
        # One unit of the last digit below the floor, so that ties after rounding are all kept.
        r, q = np.nonzero(scores >= floor - 10.0**-self.digits)
        if not len(r):
            return
        new = (q, ids[r], np.round(scores[r, q], self.digits) + 0.0)
        old = self.found[n]
        best = keep_best(*(new if old is None else map(np.concatenate, zip(old, new))), k)
        self.found[n] = best
        sizes = np.bincount(best[0], minlength=len(self.floors[n]))
        last = np.cumsum(sizes) - 1
        full = sizes == k
        self.floors[n][full] = best[2][last[full]]

    def result(self):
        """Query number, item id and score, or None when nothing was added."""
        parts = [(q + n * QUERY_SLAB, i, s) for n, f in enumerate(self.found) if f for q, i, s in [f]]
        return tuple(map(np.concatenate, zip(*parts))) if parts else None


def _id_array(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.to_numpy(zero_copy_only=False)
    return values.astype(str) if values.dtype == object else values


# --- search --------------------------------------------------------------------------------------


def vector_bytes(df: DataFrame, vector: str) -> int:
    """Size of the vectors as doubles: row count times the length of one of them."""
    one = df.select(F.size(vector).alias("n")).first()
    return 0 if one is None else 8 * one["n"] * df.count()


def top_k(
    queries: DataFrame,
    store: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vector: str = "query_embedding",
    item_id: str = "chunk_id",
    item_vector: str = "embedding",
    where: dict | None = None,
    digits: int = DIGITS,
    broadcast_bytes: int = BROADCAST_BYTES,
    tile_rows: int = 100_000,
) -> DataFrame:
    """``query_id, item_id, score, rank``: the ``k`` most similar items per query, by cosine.

    Exact. The store is never shuffled when the queries fit ``broadcast_bytes``: each task scores
    its batches by one matrix product and passes on ``k`` rows per query. More queries than that
    are cut into slabs and the store into tiles, which meet in an equi-join on (tile, slab).
    """
    items = metadata_filter(store, where).where(F.col(item_vector).isNotNull())
    items = items.select(F.col(item_id).alias("_i"), F.col(item_vector).alias("_v"))
    asked = queries.where(F.col(query_vector).isNotNull())
    # Written once: sizing, broadcasting or tiling must not embed the queries again.
    asked = materialize(asked.select(F.col(query_id).alias("_q"), F.col(query_vector).alias("_w")))
    schema = T.StructType(
        [
            T.StructField("_q", asked.schema["_q"].dataType),
            T.StructField("_i", items.schema["_i"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    size = vector_bytes(asked, "_w")
    if size <= broadcast_bytes:
        partial = _broadcast_top_k(asked, items, k, digits, schema)
    else:
        partial = _tiled_top_k(asked, items, k, digits, schema, size, broadcast_bytes, tile_rows)
    return best_of(partial, k).select(F.col("_q").alias(query_id), F.col("_i").alias(item_id), "score", "rank")


def best_of(found: DataFrame, k: int, parts: int = MERGE_PARTS) -> DataFrame:
    """The ``k`` best items of each query out of what all tasks have found, with their rank.

    Merged in two steps: first inside ``parts`` hash parts of a query, so that no task gathers what every task of
    a large store has found for one query; at most ``parts * k`` rows of it are left for the second.
    """
    part = F.pmod(F.xxhash64("_i"), F.lit(parts))
    for keys in (["_q", part], ["_q"]):
        best = Window.partitionBy(*keys).orderBy(F.desc("score"), "_i")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found


def approximate_top_k(
    queries: DataFrame,
    store: DataFrame,
    k: int = 5,
    query_id: str = "query_id",
    query_vector: str = "query_embedding",
    item_id: str = "chunk_id",
    item_vector: str = "embedding",
    min_score: float | None = None,
    target_recall: float = 0.97,
    rerank: int = 20,
    digits: int = DIGITS,
) -> DataFrame:
    """``query_id, item_id, score, rank`` for two large sides, through an index written for this search.

    See ``vector_index``: lists are probed until a sample of stored vectors finds ``target_recall`` of its exact
    neighbours, and the best ``rerank * k`` candidates of a query are compared exactly, so the work doesn't grow
    with queries times store. ``k`` rows come back for each query where the store has as many; ``min_score``
    drops those below it. Zero vectors take no part. To search again, build and keep an index.
    """
    from . import vector_index  # it uses this module's kernels

    path = run_path(store.sparkSession, "index")
    vector_index.build(store.select(item_id, item_vector), path, item_id, item_vector, None, target_recall, k)
    found = vector_index.search(queries, path, k, query_id, query_vector, item_id, item_vector, rerank=rerank, digits=digits)
    return found if min_score is None else found.where(F.col("score") >= min_score)


def _broadcast_top_k(asked, items, k, digits, schema) -> DataFrame:
    table = asked.toArrow()
    names = table.column("_q").combine_chunks()
    wanted = asked.sparkSession.sparkContext.broadcast((names, unit_rows(as_matrix(table.column("_w")))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_names, queries = wanted.value
        if not len(queries):
            return
        best, id_type = RunningBest(queries, k, digits), None
        for batch in batches:
            if batch.num_rows:
                id_type = batch.schema.field(0).type
                best.add(_id_array(batch.column(0)), unit_rows(as_matrix(batch.column(1))))
        result = best.result()
        if result:
            q, i, s = result
            yield pa.RecordBatch.from_arrays(
                [query_names.take(pa.array(q)), pa.array(i, type=id_type), pa.array(s)],
                names=["_q", "_i", "score"],
            )

    return items.mapInArrow(scan, schema)


def _tiled(items: DataFrame, asked: DataFrame, tiles: int, slabs: int) -> tuple[DataFrame, DataFrame]:
    """Items with a tile, sent to every slab; queries with a slab, sent to every tile."""

    def number(key: str, n: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = items.withColumn("_t", number("_i", tiles)).withColumn("_s", every(slabs))
    right = asked.withColumn("_s", number("_q", slabs)).withColumn("_t", every(tiles))
    return left, right


def _tiled_top_k(asked, items, k, digits, schema, size, slab_bytes, tile_rows) -> DataFrame:
    slabs = max(1, -(-size // max(1, slab_bytes)))
    tiles = max(1, -(-items.count() // tile_rows))

    left, right = _tiled(items, asked, tiles, slabs)
    names = [f.name for f in schema.fields]

    def score(key: tuple, tile: pa.Table, slab: pa.Table) -> pa.Table:
        if not tile.num_rows or not slab.num_rows:
            return pa.table({n: pa.array([], type=t) for n, t in zip(names, _types(tile, slab))})
        best = RunningBest(unit_rows(as_matrix(slab.column("_w"))), k, digits)
        best.add(_id_array(tile.column("_i")), unit_rows(as_matrix(tile.column("_v"))))
        q, i, s = best.result()
        q_type, i_type, _ = _types(tile, slab)
        found = slab.column("_q").combine_chunks().take(pa.array(q))
        return pa.table({"_q": found.cast(q_type), "_i": pa.array(i, type=i_type), "score": pa.array(s)})

    def _types(tile, slab):
        return slab.schema.field("_q").type, tile.schema.field("_i").type, pa.float64()

    return left.groupBy("_t", "_s").cogroup(right.groupBy("_t", "_s")).applyInArrow(score, schema)


def similarity_matrix(
    rows: DataFrame,
    columns: DataFrame,
    row_id: str,
    row_vector: str,
    column_id: str,
    column_vector: str,
    digits: int = DIGITS,
    broadcast_bytes: int = BROADCAST_BYTES,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """All cosine similarities: ``row_id, slab, column_ids, scores``.

    Scores stay arrays, one per row and slab of columns; pairs never become rows. Columns that fit
    ``broadcast_bytes`` form one slab that travels to the tasks. More are cut into slabs of about ``tile_rows``,
    the rows into tiles as large, and each meeting of the two scores about ``tile_rows`` squared pairs.
    """
    left = rows.where(F.col(row_vector).isNotNull())
    left = left.select(F.col(row_id).alias("_i"), F.col(row_vector).alias("_v"))
    right = columns.where(F.col(column_vector).isNotNull())
    right = materialize(right.select(F.col(column_id).alias("_q"), F.col(column_vector).alias("_w")))
    schema = T.StructType(
        [
            T.StructField("_i", left.schema["_i"].dataType),
            T.StructField("slab", T.IntegerType()),
            T.StructField("column_ids", T.ArrayType(right.schema["_q"].dataType)),
            T.StructField("scores", T.ArrayType(T.DoubleType())),
        ]
    )
    names = [f.name for f in schema.fields]

    def scored(slab: int, ids: pa.Array, vectors: np.ndarray, labels: pa.Array, queries: np.ndarray):
        scores = np.round(unit_rows(vectors) @ queries.T, digits) + 0.0
        n, width = scores.shape
        ends = pa.array(np.arange(n + 1, dtype=np.int32) * width)
        repeated = labels.take(pa.array(np.tile(np.arange(width), n)))
        return [
            ids,
            pa.array(np.full(n, slab, dtype=np.int32)),
            pa.ListArray.from_arrays(ends, repeated),
            pa.ListArray.from_arrays(ends, pa.array(scores.ravel())),
        ]

    def in_order(table: pa.Table) -> tuple[pa.Array, np.ndarray]:
        table = table.sort_by("_q")
        return table.column("_q").combine_chunks(), unit_rows(as_matrix(table.column("_w")))

    size = vector_bytes(right, "_w")
    if size <= broadcast_bytes:
        wanted = rows.sparkSession.sparkContext.broadcast(in_order(right.toArrow()))

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            labels, queries = wanted.value
            if not len(queries):
                return
            step = max(1, BLOCK_SCORES // len(queries))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    arrays = scored(0, part.column(0), as_matrix(part.column(1)), labels, queries)
                    yield pa.RecordBatch.from_arrays(arrays, names=names)

        out = left.mapInArrow(scan, schema)
    else:
        slabs = max(1, -(-right.count() // tile_rows))
        tiles = max(1, -(-left.count() // tile_rows))
        tagged, spread = _tiled(left, right, tiles, slabs)

        def score(key: tuple, tile: pa.Table, slab: pa.Table) -> pa.Table:
            ids = tile.column("_i").combine_chunks()
            if not tile.num_rows or not slab.num_rows:
                empty = [[], [], pa.array([], pa.list_(slab.schema.field("_q").type)), []]
                types = [ids.type, pa.int32(), pa.list_(slab.schema.field("_q").type), pa.list_(pa.float64())]
                return pa.table([pa.array(e, type=t) for e, t in zip(empty, types)], names=names)
            labels, queries = in_order(slab)
            return pa.table(
                scored(key[1].as_py(), ids, as_matrix(tile.column("_v")), labels, queries), names=names
            )

        out = tagged.groupBy("_t", "_s").cogroup(spread.groupBy("_t", "_s")).applyInArrow(score, schema)
    return out.withColumnRenamed("_i", row_id)


def retrieve_texts(matches: DataFrame, store: DataFrame, item_id: str, text: str) -> DataFrame:
    """Matches with their texts, without moving the texts of the whole store.

    The matches (at most k per query) are computed once and counted: few travel to the store,
    many are joined by shuffle.
    """
    return broadcast_if_small(matches).join(store.select(item_id, text), item_id)


def join_texts(retrieved: DataFrame, query_id: str, text: str, out: str = "context") -> DataFrame:
    """The retrieved texts of each query as one string, best first (a group has at most k rows)."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", F.col(text).alias("t"))))
    return (
        retrieved.groupBy(query_id)
        .agg(ranked.alias("_r"))
        .select(query_id, F.array_join(F.col("_r.t"), "\n").alias(out))
    )


def compare_searches(first: DataFrame, second: DataFrame, query_id: str, item_id: str) -> DataFrame:
    """Per query: what two searches found and how many items they share."""

    def found(df: DataFrame, name: str) -> DataFrame:
        ranked = F.array_sort(F.collect_list(F.struct("rank", F.col(item_id).alias("i"))))
        return df.groupBy(query_id).agg(ranked.alias("_r")).select(query_id, F.col("_r.i").alias(name))

    both = found(first, "first_items").join(found(second, "second_items"), query_id, "full")
    none = F.array().cast(both.schema["first_items"].dataType)
    a, b = F.coalesce("first_items", none), F.coalesce("second_items", none)
    return both.withColumn("overlap", F.size(F.array_intersect(a, b)))
