"""Searches of a stored vector index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search, vector_index
from ..session import materialize, run_path
from .registry import query, table
from .retrieval import _knn_sql, exemplars


def _stored(spark, sf) -> str:
    """An index learned from the even rows, to which the odd ones have been added later."""
    path, vecs = run_path(spark, "index"), table(spark, sf, "embeddings")
    vector_index.build(vecs.where("vec_id % 2 = 0"), path, "vec_id", "embedding")
    vector_index.append(vecs.where("vec_id % 2 != 0"), path, "vec_id", "embedding")
    return path


def _search(spark, sf, path, **options):
    asked = exemplars(spark, sf)
    found = vector_index.search(asked, path, 5, "label", "query_embedding", "vec_id", "embedding", **options)
    return found.select(F.col("label").alias("query_id"), "vec_id", "score", F.col("rank").cast("bigint").alias("rank"))


@query("N8 K9 N9", _knn_sql(""))
def index_search(spark, sf):
    """All lists probed, and the best candidates by code re-ranked exactly."""
    path = _stored(spark, sf)
    return _search(spark, sf, path, n_probe=vector_index.MAX_LISTS, rerank=100)


@query("P11 N8 N9", _knn_sql("WHERE e.label = 3"))
def index_search_filtered(spark, sf):
    """A filter inside the scan of the lists: every query still gets its rows."""
    path = _stored(spark, sf)
    return _search(spark, sf, path, where={"label": 3}, n_probe=vector_index.MAX_LISTS, rerank=100)


@query(
    "N9 N8 K9",
    "SELECT count(*) AS n_queries, count(*) * 5 AS n_rows, true AS recall_reached FROM embeddings WHERE vec_id % 50 = 0",
)
def index_recall(spark, sf):
    """Recall of the index at its calibrated defaults against exact search: at least 0.9, and k rows for each query."""
    path, vecs = _stored(spark, sf), table(spark, sf, "embeddings")
    asked = vecs.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    truth = search.top_k(asked, vecs, 5, item_id="vec_id")
    found = materialize(vector_index.search(asked, path, 5, item_id="vec_id"), "found")
    hits = F.count(F.col("t.vec_id"))
    met = found.alias("f").join(
        truth.select("query_id", "vec_id").alias("t"),
        (F.col("f.query_id") == F.col("t.query_id")) & (F.col("f.vec_id") == F.col("t.vec_id")), "left",
    )
    return met.agg(
        F.count_distinct("f.query_id").alias("n_queries"), F.count(F.lit(1)).alias("n_rows"),
        (hits / F.count(F.lit(1)) >= 0.9).alias("recall_reached"),
    )
