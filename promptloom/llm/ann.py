"""Approximate nearest neighbours: a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import share

#: The tree is fitted on so many vectors at most; it has so many children per node, and levels.
SAMPLE, BRANCHING, MAX_DEPTH = 40_000, 16, 3
#: Queries whose exact neighbours calibrate how many leaves are visited, and the recall asked of them.
CALIBRATION, TARGET_RECALL = 256, 0.98
#: Candidates and queries of one leaf that meet in one task; more are dealt out in parts.
CANDIDATES_AT_ONCE, QUERIES_AT_ONCE = 20_000, 4_000
#: Products held at a time, and vector elements of the pairs whose cosines are computed one by one.
PRODUCTS_AT_ONCE, ELEMENTS_AT_ONCE = 1 << 21, 1 << 22


@dataclass(frozen=True)
class Tree:
    """Unit centers of all nodes, the children of each, and the number of each leaf (-1 inside)."""

    centers: np.ndarray
    children: list[np.ndarray]
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def assign(self, unit: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls into, going down to the nearest center."""
        at = np.zeros(len(unit), np.int64)
        for _ in range(MAX_DEPTH + 1):
            for node in np.unique(at):
                if self.leaf[node] < 0:
                    here = np.flatnonzero(at == node)
                    inside = self.children[node]
                    at[here] = inside[(unit[here] @ self.centers[inside].T).argmax(axis=1)]
        return self.leaf[at]

    def visit(self, query: np.ndarray, n: int) -> list[int]:
        """The first ``n`` leaves, best bin first: of all nodes seen, the nearest is opened next."""
        near, heap, out = self.centers @ query, [(0.0, 0)], []
        while heap and len(out) < n:
            _, node = heapq.heappop(heap)
            if self.leaf[node] >= 0:
                out.append(int(self.leaf[node]))
            else:
                for child in self.children[node]:
                    heapq.heappush(heap, (-float(near[child]), int(child)))
        return out


def _k_means(unit: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    centers = unit[rng.choice(len(unit), k, replace=False)]
    for _ in range(rounds):
        label = (unit @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, label, unit)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(norm > 0, sums / np.where(norm > 0, norm, 1), centers)
    return centers, (unit @ centers.T).argmax(axis=1)


def grow(unit: np.ndarray, depth: int, branching: int = BRANCHING, seed: int = 5) -> Tree:
    """A tree over unit vectors; nodes with few vectors stay leaves."""
    rng = np.random.default_rng(seed)
    dim = unit.shape[1] if unit.ndim == 2 else 0
    centers, children, leaf = [np.zeros(dim)], [np.zeros(0, np.int64)], [-1]
    queue = [(0, unit, 0)]
    while queue:
        node, members, level = queue.pop()
        if level < depth and len(members) >= 4 * branching:
            found, label = _k_means(members, branching, rng)
            used = np.unique(label)
            if len(used) > 1:
                children[node] = np.arange(len(centers), len(centers) + len(used))
                for c in used:
                    queue.append((len(centers), members[label == c], level + 1))
                    centers.append(found[c])
                    children.append(np.zeros(0, np.int64))
                    leaf.append(-1)
                continue
        leaf[node] = 0
    ends = [k for k, x in enumerate(leaf) if x == 0]
    numbers = np.full(len(leaf), -1)
    numbers[ends] = np.arange(len(ends))
    return Tree(np.array(centers), children, numbers)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that squares of tiny and of huge numbers neither vanish nor overflow."""
    vectors = _scaled(vectors) if len(vectors) else vectors
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors times a power of two, which changes no bit of a cosine: one direction at lengths 1, 2, 4 ... becomes one vector."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1))
    return np.ldexp(vectors, -exponent[:, None]) + 0.0


def _smallest_of_each(vectors: np.ndarray, first_ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k smallest first ids of every distinct vector."""
    rows = np.ascontiguousarray(vectors)
    _, group = np.unique(rows.view(f"V{rows.itemsize * rows.shape[1]}").ravel(), return_inverse=True)
    order = np.lexsort((first_ids, group))
    return np.sort(order[_place(group[order]) < k])


def _place(sorted_keys: np.ndarray) -> np.ndarray:
    """The number of each row within its run of equal keys."""
    first = np.r_[0, np.flatnonzero(np.diff(sorted_keys)) + 1]
    return np.arange(len(sorted_keys)) - np.repeat(first, np.diff(np.r_[first, len(sorted_keys)]))


def _best(queries: np.ndarray, candidates: np.ndarray, first_ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """``query, candidate, score`` of the k nearest of each query: by cosine, then by the smaller first id.

    A matrix product of unit vectors gives the floor that the k-th best reaches. The cosines of all candidates
    within rounding of it are then computed one by one, so no tie is cut before ids decide. Of
    candidates that differ by a power of two only, k are enough.
    """
    queries, candidates = _scaled(queries), _scaled(candidates)
    kept = _smallest_of_each(candidates, first_ids, k)
    candidates, first_ids = candidates[kept], first_ids[kept]
    few = min(k, len(candidates))
    q_unit, c_unit = _unit(queries), _unit(candidates)
    q_norm, c_norm = (np.sqrt((v * v).sum(axis=1)) for v in (queries, candidates))
    rounding = (8 * queries.shape[1] + 32) * np.finfo(np.float64).eps
    slab, pairs = max(1, min(256, PRODUCTS_AT_ONCE // len(candidates))), max(1, ELEMENTS_AT_ONCE // queries.shape[1])
    out = []
    for at in range(0, len(queries), slab):
        near = q_unit[at : at + slab] @ c_unit.T
        floor = np.partition(near, len(candidates) - few, axis=1)[:, len(candidates) - few]
        rows, cols = np.nonzero(near >= (floor - rounding)[:, None])
        rows += at
        score = np.empty(len(rows))
        for start in range(0, len(rows), pairs):
            some = slice(start, start + pairs)
            score[some] = (queries[rows[some]] * candidates[cols[some]]).sum(axis=1) / (q_norm[rows[some]] * c_norm[cols[some]])
        order = np.lexsort((first_ids[cols], -score, rows))
        order = order[_place(rows[order]) < k]
        out.append((rows[order], kept[cols[order]], score[order]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _candidate_rows(ids: list, rows: np.ndarray, cols: np.ndarray, score: np.ndarray, v1: np.ndarray, v2: np.ndarray) -> dict:
    lengths = [len(ids[c]) for c in cols]
    return {
        "v1": np.repeat(v1[rows], lengths), "v2": np.repeat(v2[rows], lengths),
        "vec_id": np.array([i for c in cols for i in ids[c]], dtype=np.int64), "score": np.repeat(score, lengths),
    }


_HITS = "v1 long, v2 long, vec_id long, score double"


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each query vector; what a task can rule out is ruled out before the shuffle."""
    order = Window.partitionBy("v1", "v2").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def nearest(
    vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
    target_recall: float = TARGET_RECALL, sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: nearest rows by cosine for each row whose id is divisible by ``every``.

    The tree is fitted on a bounded sample and all vectors are dealt to its leaves. A sample of queries
    is compared with every vector; the number of leaves to visit is widened until the neighbours found
    among them reach ``target_recall``. Then each query is sent to that many leaves, best bin first.
    Queries and vectors meet by leaf in parts of bounded size.

    Equal vectors are one candidate with their k + 1 smallest ids, and one query, so a vector that a
    third of the rows share costs no more than any other, and no result is lost. Rows with a null id or
    a null, zero, or non-finite vector, or one of another length than most, take no part. An id that comes
    twice with one vector counts once; with two vectors, it is a candidate and a query with both, its best cosine
    counting on either side. With fewer candidates than ``k`` all are returned; ties go to the
    smaller id; a query is never its own neighbour.
    """
    spark = vectors.sparkSession
    v = F.col(vector_col).cast("array<double>")
    usable = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists("v", lambda x: x != 0)
    )
    lengths = usable.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not lengths:
        return spark.createDataFrame([], result)
    usable = usable.where(F.size("v") == lengths[0]["n"]).distinct()

    smallest = Window.partitionBy("v").orderBy("id")
    distinct = materialize(
        usable.withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= k + 1)
        .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .select(F.xxhash64("v").alias("v1"), F.xxhash64(F.lit(7), "v").alias("v2"), "v", "ids"),
        "vectors",
    )
    total = distinct.count()
    cutoff = min(int(-(1 << 63) + min(1.0, sample / total) * ((1 << 64) - 1)), (1 << 63) - 1)
    chosen = distinct.where(F.col("v1") <= cutoff).select("v1", "v")
    depth = min(MAX_DEPTH, max(1, math.ceil(math.log(math.sqrt(total)) / math.log(BRANCHING)))) if total > 1 else 1

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(b.column(1)) for b in batches if b.num_rows]
        tree = grow(_unit(np.concatenate(parts)) if parts else np.zeros((0, 0)), depth)
        yield pa.RecordBatch.from_pylist(
            [{"center": c.tolist(), "children": ch.tolist(), "leaf": int(n)} for c, ch, n in zip(tree.centers, tree.children, tree.leaf)],
            schema=pa.schema([("center", pa.list_(pa.float64())), ("children", pa.list_(pa.int64())), ("leaf", pa.int64())]),
        )

    nodes = chosen.repartition(1).sortWithinPartitions("v1").mapInArrow(fit, "center array<double>, children array<long>, leaf long").collect()
    tree = Tree(
        np.array([r.center or [0.0] * lengths[0]["n"] for r in nodes], dtype=np.float64),
        [np.array(r.children, dtype=np.int64) for r in nodes], np.array([r.leaf for r in nodes]),
    )
    shared = share(spark, tree)  # at most 16 + 256 + 4,096 centers

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaf = shared.value.assign(_unit(_matrix(b.column(2))))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=["v1", "v2", "v", "ids", "leaf"])

    placed = materialize(distinct.mapInArrow(assign, "v1 long, v2 long, v array<double>, ids array<long>, leaf long"), "leaves")
    asked = usable.where(F.col("id") % every == 0).select(F.col("id").alias("query_id"), F.xxhash64("v").alias("v1"), F.xxhash64(F.lit(7), "v").alias("v2"))
    asked = materialize(asked, "asked")
    queries = placed.join(asked.select("v1", "v2").distinct(), ["v1", "v2"], "left_semi").select("v1", "v2", "v")
    queries = materialize(queries, "queries")
    visits = _calibrated(queries, placed, tree, k, target_recall)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaves = [shared.value.visit(q, visits) for q in _unit(_matrix(b.column(2)))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaves, pa.list_(pa.int64()))], names=["v1", "v2", "v", "leaf"])

    routed = materialize(
        queries.mapInArrow(route, "v1 long, v2 long, v array<double>, leaf array<long>").withColumn("leaf", F.explode("leaf")), "routed"
    )
    # One row per leaf: how many parts its candidates and its queries are dealt out to.
    parts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / CANDIDATES_AT_ONCE).cast("int").alias("c")).join(
        routed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERIES_AT_ONCE).cast("int").alias("q")), "leaf"
    )
    parts = F.broadcast(parts)

    def spread(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = placed.join(parts, "leaf").withColumn("cp", F.pmod("v1", "c")).withColumn("qp", spread("q"))
    right = routed.join(parts, "leaf").withColumn("qp", F.pmod("v1", "q").cast("int")).withColumn("cp", spread("c"))
    keys = ["leaf", "cp", "qp"]

    def compare(cands: pd.DataFrame, asks: pd.DataFrame) -> pd.DataFrame:
        if not len(cands) or not len(asks):
            return pd.DataFrame({"v1": [], "v2": [], "vec_id": [], "score": []}).astype({"v1": "int64", "v2": "int64", "vec_id": "int64"})
        ids = cands["ids"].tolist()
        rows, cols, score = _best(np.stack(asks["v"]), np.stack(cands["v"]), np.array([i[0] for i in ids]), k + 1)
        return pd.DataFrame(_candidate_rows(ids, rows, cols, score, asks["v1"].to_numpy(), asks["v2"].to_numpy()))

    hits = (
        left.select(*[F.col(c).cast("long") for c in keys], "v", "ids").groupBy(*keys)
        .cogroup(right.select(*[F.col(c).cast("long") for c in keys], "v", "v1", "v2").groupBy(*keys))
        .applyInPandas(compare, _HITS)
    )
    best = _top(hits, k + 1)
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.join(best, ["v1", "v2"]).where("query_id != vec_id")
        .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _calibrated(queries: DataFrame, placed: DataFrame, tree: Tree, k: int, target: float) -> int:
    """The fewest leaves whose vectors hold ``target`` of the true neighbours of a sample of queries."""
    total = queries.count()
    if not total:
        return 1
    limit = min(int(-(1 << 63) + min(1.0, 1.5 * CALIBRATION / total) * ((1 << 64) - 1)), (1 << 63) - 1)
    some = queries.where(F.col("v2") <= limit).orderBy("v2", "v1").limit(CALIBRATION).collect()
    if not some:
        return tree.leaves
    v1, v2 = (np.array([r[c] for r in some], dtype=np.int64) for c in ("v1", "v2"))
    asks = np.array([r["v"] for r in some], dtype=np.float64)
    block = share(placed.sparkSession, (v1, v2, asks))  # a bounded sample

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q1, q2, q = block.value
        for b in batches:
            if b.num_rows:
                first = np.array([i[0] for i in b.column(3).to_pylist()])
                rows, cols, score = _best(q, _matrix(b.column(2)), first, k + 1)
                leaf = b.column(4).to_numpy()[cols]
                # A query's own vector is no neighbour.
                other = (q1[rows] != b.column(0).to_numpy()[cols]) | (q2[rows] != b.column(1).to_numpy()[cols])
                columns = [q1[rows], q2[rows], leaf, score]
                yield pa.RecordBatch.from_arrays([pa.array(c[other]) for c in columns], names=["v1", "v2", "vec_id", "score"])

    truth = _top(placed.select("v1", "v2", "v", "ids", "leaf").mapInArrow(scan, _HITS), k).collect()
    order = {(a, b): tree.visit(q, tree.leaves) for a, b, q in zip(v1.tolist(), v2.tolist(), _unit(asks))}
    # ``vec_id`` holds the leaf here; how many leaves must be seen to find each true neighbour.
    needed = sorted(order[r["v1"], r["v2"]].index(r["vec_id"]) + 1 for r in truth)
    if not needed:
        return tree.leaves
    return needed[min(len(needed) - 1, math.ceil(target * len(needed)) - 1)]
