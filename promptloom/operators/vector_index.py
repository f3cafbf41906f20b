"""A stored vector index: inverted lists of product-quantised residuals in Parquet, re-ranked exactly."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors
from ..session import materialize
from .search import DIGITS, _id_array, as_matrix, keep_best, metadata_filter, top_k, unit_rows

#: Vectors that centers and codebooks are learned from, at most.
SAMPLE = 65_536
#: Lists at most; codewords of each codebook; dimensions of a subspace.
MAX_LISTS, CODEWORDS, SUBSPACE = 4_096, 256, 4
#: Vectors whose exact neighbours calibrate how many lists are probed, and the share to be found there.
CALIBRATION, TARGET_RECALL = 128, 0.97
#: Candidates per result that are compared exactly.
RERANK = 20
#: Queries up to this number travel to the stored lists; more meet them by list.
QUERIES_PER_TASK = 4_096
#: Rows of a list that meet queries in one task, and that one file holds.
ROWS_PER_PART = 100_000
#: Approximate scores, or products with centers or codewords, held at once by one task.
SCORES_AT_ONCE = 2_000_000
#: Queries whose tables of products a task of met lists holds at once.
QUERIES_AT_ONCE = 512


@dataclass(frozen=True)
class IndexModel:
    """Centers of the lists, codebooks ``(subspace, codeword, dimension)``, and lists to probe by default."""

    centers: np.ndarray
    codebooks: np.ndarray
    n_probe: int = 1

    @property
    def dimension(self) -> int:
        return self.centers.shape[1]

    def _cut(self, rows: np.ndarray) -> np.ndarray:
        """Rows as ``(row, subspace, dimension)``, the last subspace filled with zeros."""
        m, _, width = self.codebooks.shape
        return np.pad(rows, ((0, 0), (0, m * width - rows.shape[1]))).reshape(len(rows), m, width)

    def encode(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List number and one byte per subspace of each unit row."""
        lists = np.concatenate([(unit[b] @ self.centers.T).argmax(axis=1) for b in _row_blocks(len(unit), len(self.centers))])
        rest = self._cut(unit - self.centers[lists])
        codes = np.empty(rest.shape[:2], np.uint8)
        for m, book in enumerate(self.codebooks):
            codes[:, m] = ((book * book).sum(axis=1) - 2 * rest[:, m] @ book.T).argmin(axis=1)
        return lists, codes

    def probes(self, unit: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` lists with the nearest centers, for each row."""
        blocks = _row_blocks(len(unit), len(self.centers))
        return np.concatenate([np.argsort(-(unit[b] @ self.centers.T), axis=1, kind="stable")[:, :n] for b in blocks])

    def tables(self, unit: np.ndarray) -> np.ndarray:
        """Products of every row's subspaces with all codewords; a code's score is the sum of its entries."""
        return np.einsum("qmd,mkd->qmk", self._cut(unit), self.codebooks)


def _row_blocks(n: int, width: int) -> list[slice]:
    """``n`` rows in blocks that have at most ``SCORES_AT_ONCE`` scores of ``width`` each; one block of none for no rows."""
    step = max(1, SCORES_AT_ONCE // max(1, width))
    return [slice(a, a + step) for a in range(0, max(1, n), step)]


def _nearest(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    size = (centers * centers).sum(axis=1)
    return np.concatenate([(size - 2 * rows[b] @ centers.T).argmin(axis=1) for b in _row_blocks(len(rows), len(centers))])


def _k_means(rows: np.ndarray, k: int, seed: int, rounds: int = 10) -> np.ndarray:
    """Centers by Lloyd's rounds; a center that loses all rows stays where it is."""
    rng = np.random.default_rng(seed)
    centers = rows[rng.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        label = _nearest(rows, centers)
        count = np.bincount(label, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, label, rows)
        centers[count > 0] = sums[count > 0] / count[count > 0, None]
    return centers


def learn(unit: np.ndarray, n_lists: int, subspace: int = SUBSPACE, seed: int = 7) -> IndexModel:
    """Centers and codebooks of a sample of unit rows."""
    centers = _k_means(unit, n_lists, seed)
    m = -(-unit.shape[1] // subspace)
    rest = np.pad(unit - centers[_nearest(unit, centers)], ((0, 0), (0, m * subspace - unit.shape[1])))
    books = [_k_means(rest[:, i * subspace : (i + 1) * subspace], CODEWORDS, seed + i) for i in range(m)]
    return IndexModel(centers, np.stack(books))


def _usable(df: DataFrame, vector: str, dimension: int | None = None) -> DataFrame:
    """Rows with a vector of finite numbers that are not all zero (of the index's dimension)."""
    v = F.col(vector)
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = df.where(v.isNotNull() & ~odd & F.exists(v, lambda x: x != 0))
    return kept if dimension is None else kept.where(F.size(v) == dimension)


def fit(store: DataFrame, vector: str = "embedding", n_lists: int | None = None, sample: int = SAMPLE) -> IndexModel:
    """Learn lists and codebooks from at most ``sample`` distinct vectors, chosen by a hash of the vector.

    The dimension is that of most vectors. About the square root of the rows makes the number of lists.
    """
    rows = _usable(store, vector).select(F.col(vector).cast("array<double>").alias("v"))
    shapes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not shapes:
        raise ValueError("no usable vector to learn an index from")
    dimension, total = shapes[0]["d"], shapes[0]["count"]
    n_lists = n_lists or max(1, min(MAX_LISTS, round(math.sqrt(total))))
    order = F.xxhash64("v")
    some = rows.where(F.size("v") == dimension).withColumn("o", order)
    if total > sample:
        some = some.where(F.col("o") < int(-(1 << 63) + min(1.0, 1.2 * sample / total) * ((1 << 64) - 1)))
    some = some.dropDuplicates(["o"]).orderBy("o").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [as_matrix(b.column(0)) for b in batches if b.num_rows]
        if parts:
            yield _model_rows(learn(unit_rows(np.concatenate(parts)), n_lists))

    rows = some.select("v").repartition(1).mapInArrow(run, _MODEL).collect()
    return _model_of(rows)


_MODEL = "kind string, number int, part int, values array<double>"


def _model_rows(model: IndexModel) -> pa.RecordBatch:
    rows = [("center", i, 0, c.tolist()) for i, c in enumerate(model.centers)]
    rows += [("codeword", k, m, w.tolist()) for m, book in enumerate(model.codebooks) for k, w in enumerate(book)]
    rows.append(("probe", model.n_probe, 0, []))
    names = [c.split()[0] for c in _MODEL.split(", ")]
    types = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64())]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _model_of(rows: list) -> IndexModel:
    centers = [r["values"] for r in sorted((r for r in rows if r["kind"] == "center"), key=lambda r: r["number"])]
    parts: dict[int, list] = {}
    for r in sorted((r for r in rows if r["kind"] == "codeword"), key=lambda r: (r["part"], r["number"])):
        parts.setdefault(r["part"], []).append(r["values"])
    probe = next(r["number"] for r in rows if r["kind"] == "probe")
    return IndexModel(np.array(centers), np.array([parts[m] for m in sorted(parts)]), probe)


def load_model(spark: SparkSession, path: str) -> IndexModel:
    """Centers and codebooks of a stored index: a bounded table, whatever the number of rows."""
    return _model_of(spark.read.parquet(f"{path}/model").collect())


def build(
    store: DataFrame, path: str, item_id: str = "chunk_id", vector: str = "embedding", n_lists: int | None = None,
    target_recall: float = TARGET_RECALL, k: int = 5,
) -> IndexModel:
    """Learn an index, calibrate it on stored vectors, and write all rows of ``store`` under ``path``.

    The number of lists that a search probes is the least at which ``target_recall`` of the exact
    ``k`` neighbours of a sample of stored vectors stand in probed lists.
    """
    spark = store.sparkSession
    model = fit(store, vector, n_lists)
    append(store, path, item_id, vector, model)
    rows = spark.read.parquet(f"{path}/data")
    some = rows.orderBy(F.xxhash64(F.lit(3), item_id), item_id).limit(CALIBRATION)
    some = materialize(some.select(F.col(item_id).alias("query_id"), F.col(vector).alias("query_embedding")), "asked")
    truth = top_k(some, rows, k + 1, item_id=item_id, item_vector=vector).where(F.col("query_id") != F.col(item_id))
    where = rows.select(F.col(item_id).alias("of"), "list")
    met = materialize(truth, "truth").join(where, F.col(item_id) == F.col("of")).select("query_id", "list").collect()
    asked = some.collect()
    order = model.probes(unit_rows(np.array([r["query_embedding"] for r in asked], dtype=np.float64)), len(model.centers))
    place = {r["query_id"]: {int(x): n for n, x in enumerate(o)} for r, o in zip(asked, order)}
    needed = sorted(place[r["query_id"]][r["list"]] + 1 for r in met)
    n_probe = needed[math.ceil(target_recall * len(needed)) - 1] if needed else 1
    model = IndexModel(model.centers, model.codebooks, n_probe)
    spark.createDataFrame(_model_rows(model).to_pylist(), _MODEL).coalesce(1).write.parquet(f"{path}/model")
    return model


def append(
    rows: DataFrame, path: str, item_id: str = "chunk_id", vector: str = "embedding", model: IndexModel | None = None
) -> None:
    """Add rows to an index without learning it anew: each goes to its list with its code.

    Files are partitioned by list and hold the code, the vector for re-ranking, and all other columns, so a
    search reads the probed lists only, and of these ids, codes and filtered columns first. Rows with a null
    id, or a vector that is null, zero, not finite or of another dimension are left out. Ids must be
    unique in the index.
    """
    spark = rows.sparkSession
    known = model or load_model(spark, path)
    shared = spark.sparkContext.broadcast((known.centers, known.codebooks))
    kept = _usable(rows.where(F.col(item_id).isNotNull()), vector, known.dimension)
    packed = kept.select(F.col(vector).cast("array<double>").alias("v"), F.struct("*").alias("row"))
    schema = T.StructType(
        [packed.schema["row"], T.StructField("list", T.IntegerType()), T.StructField("code", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = IndexModel(*shared.value)
        for batch in batches:
            if batch.num_rows:
                lists, codes = own.encode(unit_rows(as_matrix(batch.column(0))))
                columns = [batch.column(1), pa.array(lists, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    coded = materialize(packed.mapInArrow(run, schema), "coded")
    # A list that holds many of the rows is written by several tasks.
    sizes = coded.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_PART).alias("parts"))
    spread = coded.join(F.broadcast(sizes), "list")  # a row for each list
    salt = F.pmod(F.xxhash64(f"row.`{item_id}`"), F.col("parts"))
    spread.withColumn("salt", salt).repartition("list", "salt").select("row.*", "list", "code").write.mode("append").partitionBy(
        "list"
    ).option("maxRecordsPerFile", ROWS_PER_PART).parquet(f"{path}/data")


class _Candidates:
    """The best ``keep`` codes of each query seen so far, equal scores by the smaller id."""

    def __init__(self, tables: np.ndarray, keep: int):
        self.tables, self.keep, self.found = np.asarray(tables, np.float32), keep, None

    def add(self, queries: np.ndarray, base: np.ndarray, ids: np.ndarray, codes: np.ndarray) -> None:
        """Codes of one list; ``queries`` (numbers) probe it, ``base`` has their products with its center."""
        step = max(1, SCORES_AT_ONCE // max(1, len(queries)))
        for at in range(0, len(ids), step):
            part = codes[at : at + step]
            scores = np.repeat(base.astype(np.float32)[:, None], len(part), axis=1)
            for m in range(part.shape[1]):
                scores += self.tables[queries, m][:, part[:, m]]
            few = min(self.keep, len(part))
            floor = np.partition(scores, len(part) - few, axis=1)[:, len(part) - few]
            q, i = np.nonzero(scores >= floor[:, None])
            new = (queries[q], ids[at : at + step][i], scores[q, i])
            both = new if self.found is None else tuple(np.concatenate(x) for x in zip(self.found, new))
            self.found = keep_best(*both, self.keep)


def _codes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def search(
    queries: DataFrame, path: str, k: int = 5, query_id: str = "query_id", query_vector: str = "query_embedding",
    item_id: str = "chunk_id", vector: str = "embedding", where: dict | Column | None = None,
    n_probe: int | None = None, rerank: int = RERANK, digits: int = DIGITS,
) -> DataFrame:
    """``query_id, item_id, score, rank``: neighbours by cosine out of a stored index.

    Each query probes the lists with the nearest centers; codes there are scored by table look-ups, and the
    best ``rerank * k`` of each query are compared exactly with the stored vectors. ``where``
    (equalities, or a condition) is applied inside the scan of the lists, before candidates are chosen. Queries
    that find fewer than ``k`` items so (a narrow filter, short lists) probe all lists in a second
    pass, so ``k`` rows come back wherever the filter leaves that many. With ``n_probe`` of all lists and
    ``rerank`` of all rows the search is exact. Queries that are null, zero or of another dimension get no rows.
    """
    spark = queries.sparkSession
    model = load_model(spark, path)
    asked = _usable(queries.where(F.col(query_id).isNotNull()), query_vector, model.dimension)
    asked = asked.select(F.col(query_id).alias("_q"), F.col(query_vector).cast("array<double>").alias("_w"))
    asked = materialize(asked, "asked")
    items = spark.read.parquet(f"{path}/data")
    items = items.where(where) if isinstance(where, Column) else metadata_filter(items, where)
    lists = len(model.centers)
    probes = min(lists, n_probe or model.n_probe)
    best = _searched(asked, items, model, k, item_id, vector, probes, rerank, digits)
    if probes < lists:
        best = materialize(best, "found")
        few = best.groupBy("_q").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).select("_q")
        rest = materialize(asked.join(few, "_q", "left_anti"), "unsatisfied")
        if not rest.isEmpty():
            again = _searched(rest, items, model, k, item_id, vector, lists, rerank, digits)
            best = best.join(rest, "_q", "left_anti").unionByName(again)
    return best.select(F.col("_q").alias(query_id), F.col("_i").alias(item_id), "score", "rank")


def _searched(
    asked: DataFrame, items: DataFrame, model: IndexModel, k: int, item_id: str, vector: str, probes: int, rerank: int, digits: int
) -> DataFrame:
    keep = rerank * k
    stored = items.select(F.col(item_id).alias("_i"), "list", "code")
    schema = T.StructType(
        [asked.schema["_q"], T.StructField("_i", stored.schema["_i"].dataType), T.StructField("list", T.IntegerType()),
         T.StructField("near", T.FloatType())]
    )
    if asked.limit(QUERIES_PER_TASK + 1).count() <= QUERIES_PER_TASK:
        found = _sent_to_lists(asked, stored, model, keep, probes, schema)
    else:
        found = _met_by_list(asked, stored, model, keep, probes, schema)
    # In two steps, so that no task merges what all tasks have found for one query.
    part = F.pmod(F.xxhash64("_i"), F.lit(64))
    for keys in (["_q", part], ["_q"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("near"), "_i")
        found = found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep).drop("place")
    found = materialize(found, "candidates")
    needed = [r["list"] for r in found.select("list").distinct().collect()]  # at most as many as there are lists
    full = items.where(F.col("list").isin(needed)).select(
        F.col(item_id).alias("_j"), F.col("list").alias("_l"), F.col(vector).alias("_v")
    )
    met = found.join(full, (F.col("list") == F.col("_l")) & (F.col("_i") == F.col("_j"))).join(asked, "_q")
    score = F.round(vectors.cosine("_v", "_w"), digits) + F.lit(0.0)
    order = Window.partitionBy("_q").orderBy(F.desc("score"), "_i")
    return met.select("_q", "_i", score.alias("score")).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _sent_to_lists(asked: DataFrame, stored: DataFrame, model: IndexModel, keep: int, probes: int, schema: T.StructType) -> DataFrame:
    """A bounded number of queries travel to the tasks; codes are scored where they are stored."""
    table = asked.toArrow()
    names, unit = table.column("_q").combine_chunks(), unit_rows(as_matrix(table.column("_w")))
    chosen = model.probes(unit, probes) if len(unit) else np.zeros((0, 1), int)
    shared = asked.sparkSession.sparkContext.broadcast((names, unit, chosen, model.centers, model.codebooks))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, unit, chosen, centers, codebooks = shared.value
        if not len(unit):
            return
        own = IndexModel(centers, codebooks)
        blocks = _row_blocks(len(unit), codebooks.shape[0] * codebooks.shape[1])
        best, home, id_type = {}, np.concatenate([own.tables(unit[b]).astype(np.float32) for b in blocks]), None
        for batch in batches:
            lists = batch.column(1).to_numpy()
            ids, codes, id_type = _id_array(batch.column(0)), _codes(batch.column(2)) if batch.num_rows else None, batch.schema.field(0).type
            for number in np.unique(lists):
                probing = np.flatnonzero((chosen == number).any(axis=1))
                if len(probing):
                    here = lists == number
                    at = best.setdefault(int(number), _Candidates(home, keep))
                    at.add(probing, unit[probing] @ own.centers[number], ids[here], codes[here])
        for number, at in best.items():
            q, i, s = at.found
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(q)), pa.array(i, type=id_type), pa.array(np.full(len(q), number), pa.int32()), pa.array(s, pa.float32())],
                names=schema.names,
            )

    needed = sorted({int(x) for x in chosen.ravel()})  # a filter on the partition column: other lists aren't read
    return stored.where(F.col("list").isin(needed)).mapInArrow(scan, schema)


def _met_by_list(asked: DataFrame, stored: DataFrame, model: IndexModel, keep: int, probes: int, schema: T.StructType) -> DataFrame:
    """Any number of queries meet the codes by list, in parts of bounded size on both sides."""
    shared = asked.sparkSession.sparkContext.broadcast((model.centers, model.codebooks))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = IndexModel(*shared.value)
        for b in batches:
            if b.num_rows:
                chosen = own.probes(unit_rows(as_matrix(b.column(1))), probes)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(chosen.tolist(), pa.list_(pa.int32()))], names=["_q", "_w", "list"])

    routed = asked.mapInArrow(route, T.StructType([*asked.schema.fields, T.StructField("list", T.ArrayType(T.IntegerType()))]))
    routed = materialize(routed.withColumn("list", F.explode("list")), "routed")
    rows = stored.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_PART).cast("int").alias("a"))
    asks = routed.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERIES_PER_TASK).cast("int").alias("b"))
    parts = F.broadcast(rows.join(asks, "list"))  # a row for each list

    def number(key: str, n: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(n)).cast("int")

    def every(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    keys = ["list", "x", "y"]
    left = stored.join(parts, "list").withColumn("x", number("_i", "a")).withColumn("y", every("b")).select(*keys, "_i", "code")
    right = routed.join(parts, "list").withColumn("y", number("_q", "b")).withColumn("x", every("a")).select(*keys, "_q", "_w")

    def score(key: tuple, codes: pa.Table, asks: pa.Table) -> pa.Table:
        q_type, i_type = asks.schema.field("_q").type, codes.schema.field("_i").type
        q, i, s = np.zeros(0, int), [], []
        if codes.num_rows and asks.num_rows:
            own, unit = IndexModel(*shared.value), unit_rows(as_matrix(asks.column("_w")))
            ids, known = _id_array(codes.column("_i")), _codes(codes.column("code").combine_chunks())
            parts = []
            for at in range(0, len(unit), QUERIES_AT_ONCE):
                some = unit[at : at + QUERIES_AT_ONCE]
                best = _Candidates(own.tables(some), keep)
                best.add(np.arange(len(some)), some @ own.centers[key[0].as_py()], ids, known)
                parts.append((best.found[0] + at, *best.found[1:]))
            q, i, s = map(np.concatenate, zip(*parts))
        names = asks.column("_q").combine_chunks().take(pa.array(q)).cast(q_type) if asks.num_rows else pa.array([], q_type)
        number = key[0].as_py() or 0
        return pa.table(
            [names, pa.array(i, i_type), pa.array([number] * len(q), pa.int32()), pa.array(s, pa.float32())], names=schema.names
        )

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, schema)


def recall(found: DataFrame, truth: DataFrame, query_id: str, item_id: str) -> float:
    """The share of the true neighbours that a search has found."""
    both = truth.select(query_id, item_id).join(found.select(query_id, item_id), [query_id, item_id], "left_semi").count()
    total = truth.count()
    return both / total if total else 1.0
