import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom.functions import prompts, vectors
from promptloom.models import standins
from promptloom.operators import chunk, product, search, tokenize

WORDS = "word"


def chunks_of(spark, text, size, overlap):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = chunk.chunk_tokens(df, size=size, overlap=overlap).orderBy("chunk_no").collect()
    return [r["chunk"] for r in rows]


def splitter(n, size, overlap):
    """Start and end of each piece as a sliding token window gives them."""
    spans, start = [], 0
    while start < n:
        spans.append((start, min(start + size, n)))
        if spans[-1][1] == n:
            break
        start += size - overlap
    return spans


@pytest.mark.parametrize("n", [0, 1, 34, 35, 36, 66, 67, 100])
def test_token_chunks(spark, n):
    text = " ".join(f"w{i}" for i in range(n))
    pieces = [(" " if i else "") + f"w{i}" for i in range(n)]
    expected = ["".join(pieces[a:b]) for a, b in splitter(n, 35, 4)]
    assert chunks_of(spark, text, 35, 4) == expected


def test_published_chunk_sizes(spark):
    for n, count in [(3500, 1), (3501, 2), (6600, 2), (6601, 3)]:
        assert len(chunks_of(spark, "a " * n, 3500, 400)) == count


@settings(max_examples=15, deadline=None)
@given(st.text(alphabet="aé😀 \n", max_size=40), st.integers(1, 7))
def test_character_chunks_rebuild_the_text(spark, text, size):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    rows = chunk.chunk_characters(df, size=size).orderBy("chunk_no").collect()
    assert [r["chunk"] for r in rows] == [text[i : i + size] for i in range(0, len(text), size)]


def test_chunks_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "abcdef", "x")], "id int, text string, m string")
    assert chunk.chunk_characters(df, size=4).columns == ["id", "m", "chunk_no", "chunk"]


def test_training_pairs(spark):
    df = spark.createDataFrame([("q", ["a", "b"]), ("r", []), ("s", None)], "q string, pos array<string>")
    pairs = chunk.training_pairs(df, "q", "pos", prompts.query)
    assert sorted(map(tuple, pairs.collect())) == [("query: q", "a"), ("query: q", "b")]


def test_cosine_and_normalize(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.coalesce(1).select(vectors.cosine("a", "b"), vectors.normalize("a")).collect()
    assert rows[0][0] == pytest.approx(0.96) and rows[0][1] == pytest.approx([0.6, 0.8])
    assert rows[1][0] == 0.0 and rows[1][1] == [0.0, 0.0]


def brute(items, queries, k):
    best = {}
    for q, w in queries:
        scored = []
        for i, v in items:
            size = np.linalg.norm(v) * np.linalg.norm(w)
            scored.append((-round(float(np.dot(v, w) / size) if size else 0.0, 6) + 0.0, i))
        best[q] = [(i, -s + 0.0) for s, i in sorted(scored)[:k]]
    return best


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    items = [(i, rng.integers(-3, 4, 8).astype(float)) for i in range(400)]
    # A third of the items are copies of one vector, and one vector is zero.
    items = [(i, items[0][1] if i % 3 == 0 else v) for i, v in items]
    items[5] = (5, np.zeros(8))
    return items, [(f"q{j}", rng.integers(-3, 4, 8).astype(float)) for j in range(30)] + [("q_hot", items[0][1])]


def frames(spark, data):
    items, queries = data
    store = spark.createDataFrame([(i, v.tolist(), i % 4) for i, v in items], "chunk_id long, embedding array<float>, g long")
    asked = spark.createDataFrame([(q, w.tolist()) for q, w in queries], "query_id string, query_embedding array<float>")
    return store.repartition(6), asked


@pytest.mark.parametrize("limit", [1 << 20, 500])
@pytest.mark.parametrize("block,slab", [(4_000_000, 4096), (100, 4096), (60, 7)])
def test_search_is_exact(spark, data, limit, block, slab, monkeypatch):
    """Broadcast and tiled path, whole and sliced score blocks, all equal brute force."""
    monkeypatch.setattr(search, "BLOCK_SCORES", block)
    monkeypatch.setattr(search, "QUERY_SLAB", slab)
    store, asked = frames(spark, data)
    found = search.top_k(asked, store, 7, broadcast_bytes=limit, tile_rows=90).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["query_id"], []).append((r["chunk_id"], r["score"]))
    want = brute(*data, 7)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=2e-6)


def test_filters_apply_before_the_search(spark, data):
    store, asked = frames(spark, data)
    found = search.top_k(asked, store, 3, where={"g": 2}).collect()
    assert len(found) == 31 * 3 and all(r["chunk_id"] % 4 == 2 for r in found)
    assert search.top_k(asked, store, 3, where={"g": 99}).count() == 0
    assert search.top_k(asked.where("false"), store, 3).count() == 0
    assert search.top_k(asked, store.limit(2), 3).count() == 62


def test_string_ids(spark, data):
    store, asked = frames(spark, data)
    named = store.withColumn("chunk_id", F.format_string("c%03d", "chunk_id"))
    by_number = search.top_k(asked, store, 4).orderBy("query_id", "rank").collect()
    by_name = search.top_k(asked, named, 4).orderBy("query_id", "rank").collect()
    assert [r["chunk_id"] for r in by_name] == [f"c{r['chunk_id']:03d}" for r in by_number]


def test_vectors_of_different_length_are_refused(spark):
    store = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "chunk_id long, embedding array<float>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0])], "query_id long, query_embedding array<float>")
    with pytest.raises(Exception, match="differ in length"):
        search.top_k(asked, store).collect()


@pytest.mark.parametrize("limit", [1 << 20, 500])
def test_similarity_matrix(spark, data, limit):
    items, queries = data
    store, asked = frames(spark, data)
    rows = search.similarity_matrix(
        store, asked, "chunk_id", "embedding", "query_id", "query_embedding", broadcast_bytes=limit, tile_rows=90
    ).collect()
    got = {(r["chunk_id"], q): s for r in rows for q, s in zip(r["column_ids"], r["scores"])}
    assert len(got) == len(items) * len(queries)
    for i, v in items[:40]:
        for q, w in queries:
            size = np.linalg.norm(v) * np.linalg.norm(w)
            assert got[i, q] == pytest.approx(np.dot(v, w) / size if size else 0.0, abs=2e-6)


def test_store_and_context(spark, data, tmp_path):
    store, asked = frames(spark, data)
    search.save_store(store.withColumn("text", F.concat(F.lit("t"), "chunk_id")), str(tmp_path / "store"))
    with pytest.raises(Exception, match="(?i)exist"):
        search.save_store(store, str(tmp_path / "store"))
    saved = search.load_store(spark, str(tmp_path / "store"))
    found = search.top_k(asked, saved, 3)
    context = search.join_texts(search.retrieve_texts(found, saved, "chunk_id", "text"), "query_id", "text")
    want = brute(*data, 3)
    got = {r["query_id"]: r["context"] for r in context.collect()}
    assert got == {q: "\n".join(f"t{i}" for i, _ in v) for q, v in want.items()}
    same = search.compare_searches(found, found, "query_id", "chunk_id")
    assert {r["overlap"] for r in same.collect()} == {3}


def test_documents_and_embedding(spark):
    df = spark.createDataFrame([("a b", 1, "x")], "body string, n int, s string")
    row = search.documents(df, "body").first()
    assert row["page_content"] == "a b" and row["metadata"].asDict() == {"n": 1, "s": "x"}
    out = search.embed(df, "body", "e", standins.hash_embedder(16), normalized=True).first()["e"]
    assert len(out) == 16 and sum(x * x for x in out) == pytest.approx(1.0)


def test_combinations(spark):
    items = spark.createDataFrame([("hat",), ("sock",)], "item string")
    short = product.combinations(items, ["s1", "s2"], ["red"])
    assert {tuple(r) for r in short.collect()} == {(i, s, "red") for i in ("hat", "sock") for s in ("s1", "s2")}
    values = spark.range(100).select(F.col("id").cast("string").alias("v"))
    long = product.combinations_with(items, values, "v", rows_per_block=9)
    assert {tuple(r) for r in long.collect()} == {(i, str(v)) for i in ("hat", "sock") for v in range(100)}
    many = product.combinations(items, [str(i) for i in range(2000)], ["c"])
    assert many.distinct().count() == 4000
    # One value that fills the list, and equal items.
    same = spark.createDataFrame([("hat",)] * 3, "item string")
    equal = product.combinations_with(same, spark.range(50).select(F.lit("v").alias("v")), "v", rows_per_block=10)
    assert equal.count() == 150 and equal.distinct().count() == 1


def test_large_similarity_matrix(spark):
    """The tiled path in tiles of its own size, over several tiles and slabs."""
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(5000, 3)))]
    left = spark.createDataFrame(rows, "i long, v array<float>").repartition(3)
    right = left.select(F.col("i").alias("j"), F.col("v").alias("w")).where("j < 4500")
    out = search.similarity_matrix(left, right, "i", "v", "j", "w", broadcast_bytes=0)
    sizes = out.select("i", F.size("scores").alias("n"), F.size("column_ids").alias("m")).groupBy("i").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    assert sizes.where("n = 4500 and m = 4500").count() == 5000
    itself = out.select("i", F.arrays_zip("column_ids", "scores").alias("z")).select("i", F.explode("z").alias("z")).where("z.column_ids = i")
    assert itself.where("abs(z.scores - 1) < 1e-5").count() == 4500


def test_approximate_search_recall(spark):
    """Vectors in clusters: bucketed search finds nearly all that exact search finds."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(40, 16))
    rows = [(i, (centers[i % 40] + 0.3 * rng.normal(size=16)).tolist()) for i in range(2000)]
    store = spark.createDataFrame(rows, "chunk_id long, embedding array<float>")
    asked = store.where("chunk_id % 20 = 0").select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    exact = {(r["query_id"], r["chunk_id"]) for r in search.top_k(asked, store, 5).collect()}
    found = {(r["query_id"], r["chunk_id"]) for r in search.approximate_top_k(asked, store, 5).collect()}
    assert len(exact & found) >= 0.9 * len(exact)


def test_tokenize(spark):
    df = spark.createDataFrame([("a b c",), ("a",), ("",)], "text string").coalesce(1)
    rows = tokenize.tokenize_rows(df, "text", max_length=2, pad_to=4, pad_id=-1).collect()
    assert [len(r["input_ids"]) for r in rows] == [4, 4, 4]
    assert [r["attention_mask"] for r in rows] == [[1, 1, 0, 0], [1, 0, 0, 0], [0, 0, 0, 0]]
    assert rows[2]["input_ids"] == [-1] * 4
    assert df.transform(lambda d: tokenize.tokenize_rows(d, "text", 2)).columns == ["input_ids", "attention_mask"]
    assert tokenize.tokenize_rows(df, "text", max_length=3, only_full=True).count() == 1


def test_plugged_in_tokenizer(spark):
    def load():
        from tokenizers import Tokenizer, models, pre_tokenizers

        tokenizer = Tokenizer(models.WordLevel({"a": 5, "b": 6, "?": 0}, unk_token="?"))
        tokenizer.pre_tokenizer = pre_tokenizers.Whitespace()
        return lambda texts: [e.ids for e in tokenizer.encode_batch(texts)]

    df = spark.createDataFrame([("a b z",), ("b",)], "text string").coalesce(1)
    rows = tokenize.tokenize_rows(df, "text", max_length=2, encoder=load).collect()
    assert [r["input_ids"] for r in rows] == [[5, 6], [6]]
