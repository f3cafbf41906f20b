"""The stored vector index against exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from promptloom.operators import search, vector_index


def clustered(n, dimension=16, seed=3, clusters=40):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(clusters, dimension))
    return [(i, (centers[i % clusters] + 0.3 * rng.normal(size=dimension)).tolist(), i % 7) for i in range(n)]


@pytest.fixture(scope="module")
def store(spark):
    return spark.createDataFrame(clustered(3000), "chunk_id long, embedding array<float>, label int").repartition(4).cache()


@pytest.fixture(scope="module")
def path(spark, store, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("index") / "i")
    vector_index.build(store.where("chunk_id < 2000"), at)
    vector_index.append(store.where("chunk_id >= 2000"), at)
    return at


def asked(store, every=50):
    return store.where(F.col("chunk_id") % every == 0).select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_embedding"))


def test_recall_at_defaults(store, path):
    truth, found = search.top_k(asked(store), store, 5), vector_index.search(asked(store), path, 5)
    assert found.count() == truth.count() == 300
    assert vector_index.recall(found, truth, "query_id", "chunk_id") >= 0.95


def test_all_lists_and_rows_are_exact(store, path):
    truth = {tuple(r) for r in search.top_k(asked(store, 100), store, 5).collect()}
    found = vector_index.search(asked(store, 100), path, 5, n_probe=vector_index.MAX_LISTS, rerank=600)
    assert {tuple(r) for r in found.collect()} == truth


def test_queries_meet_by_list(store, path, monkeypatch):
    """More queries than travel to the tasks: the same candidates by a join on the lists."""
    sent = vector_index.search(asked(store), path, 5).collect()
    monkeypatch.setattr(vector_index, "QUERIES_PER_TASK", 7)
    monkeypatch.setattr(vector_index, "ROWS_PER_PART", 30)
    assert sorted(vector_index.search(asked(store), path, 5).collect()) == sorted(sent)


def test_products_with_centers_are_made_in_blocks(monkeypatch):
    """Rows meet all centers in blocks of bounded size, with the same lists, codes and probes."""
    rows = search.unit_rows(np.array([v for _, v, _ in clustered(1000)]))
    whole = vector_index.learn(rows, 30)
    lists, probes = whole.encode(rows), whole.probes(rows, 4)
    monkeypatch.setattr(vector_index, "SCORES_AT_ONCE", 2_000)
    model = vector_index.learn(rows, 30)
    assert np.allclose(model.centers, whole.centers) and np.allclose(model.codebooks, whole.codebooks)
    blocks = vector_index._row_blocks(1000, 30)
    assert max(b.stop - b.start for b in blocks) * 30 <= 2_000 and len(blocks) > 10
    assert all((a == b).all() for a, b in zip(whole.encode(rows), lists)) and (whole.probes(rows, 4) == probes).all()
    assert whole.probes(rows[:0], 4).shape == (0, 4) and len(whole.encode(rows[:0])[0]) == 0


def test_filter_keeps_k_rows(store, path):
    """One probed list rarely holds five rows of a label; the other lists are looked at then."""
    found = vector_index.search(asked(store), path, 5, where={"label": 3}, n_probe=1)
    labels = found.join(store.select("chunk_id", "label"), "chunk_id")
    assert found.count() == 5 * asked(store).count() and labels.where("label != 3").count() == 0
    few = vector_index.search(asked(store), path, 5, where=F.col("chunk_id").isin(10, 2010, 20))
    assert few.count() == 3 * asked(store).count()


def test_only_probed_lists_are_read(spark, store, path):
    model = vector_index.load_model(spark, path)
    assert len(model.centers) == round(2000**0.5) and model.n_probe < len(model.centers)
    plan = spark.read.parquet(f"{path}/data").where(F.col("list").isin(1, 2))._jdf.queryExecution().toString()
    assert "PartitionFilters: [list" in plan


def test_odd_vectors_take_no_part(spark, store, tmp_path):
    rows = clustered(200) + [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] * 16, 0), (903, [1.0] * 3, 0), (None, [1.0] * 16, 0)]
    frame = spark.createDataFrame(rows, "chunk_id long, embedding array<float>, label int")
    vector_index.build(frame, str(tmp_path / "i"))
    queries = frame.select(F.coalesce("chunk_id", F.lit(-1)).alias("query_id"), F.col("embedding").alias("query_embedding"))
    found = vector_index.search(queries.where("query_id >= 0"), str(tmp_path / "i"), 3)
    assert found.select("query_id").distinct().count() == 200 and found.where("chunk_id >= 900").count() == 0
    assert vector_index.search(queries.limit(0), str(tmp_path / "i"), 3).collect() == []
    with pytest.raises(ValueError):
        vector_index.build(frame.where("chunk_id between 900 and 902"), str(tmp_path / "j"))


def test_equal_vectors_in_one_list(spark, tmp_path):
    """A third of the rows is one vector: the smallest ids of it come back."""
    rows = [(i, v if i % 3 else [1.0] * 16, 0) for i, v, _ in clustered(900)]
    frame = spark.createDataFrame(rows, "chunk_id long, embedding array<float>, label int").repartition(5)
    vector_index.build(frame, str(tmp_path / "i"))
    query = spark.createDataFrame([(1, [1.0] * 16)], "query_id long, query_embedding array<float>")
    found = vector_index.search(query, str(tmp_path / "i"), 5).orderBy("rank").collect()
    assert [r["chunk_id"] for r in found] == [0, 3, 6, 9, 12]


def test_approximate_search_returns_k_rows(store):
    truth, found = search.top_k(asked(store), store, 5), search.approximate_top_k(asked(store), store, 5)
    assert found.count() == 300 and vector_index.recall(found, truth, "query_id", "chunk_id") >= 0.9
    assert search.approximate_top_k(asked(store), store, 5, min_score=0.9).where("score < 0.9").count() == 0


def test_merge_in_parts(spark):
    rows = [(q, i, round(((i * 37 + q) % 101) / 101, 6)) for q in range(3) for i in range(400)]
    found = spark.createDataFrame(rows, "_q long, _i long, score double")
    got = sorted((r["_q"], r["rank"], r["_i"]) for r in search.best_of(found, 4, 5).collect())
    want = [(q, n + 1, i) for q in range(3) for n, (_, i) in enumerate(sorted((-s, i) for p, i, s in rows if p == q)[:4])]
    assert got == want
