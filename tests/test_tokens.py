"""Vocabulary files, packing and batches by tokens."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom.operators import batches, chunk, packing, tokenize, vocabulary

public_tokenizers = pytest.importorskip("public_tokenizers")

FILES = {
    "json": lambda: vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.json")),
    "tiktoken": lambda: vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN),
    "model": lambda: vocabulary.from_file(public_tokenizers.path("piece_bpe_32k.model")),
}
TEXTS = ["Plain words here.", "", None, "é日本\U0001f600 and\n\ntabs\t x  y ", "word " * 700, "\U0001f600" * 300]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string").repartition(2)


@pytest.mark.parametrize("kind", sorted(FILES))
def test_ids_counts_and_text(texts, kind):
    loader = FILES[kind]()
    rows = vocabulary.with_token_counts(vocabulary.with_ids(texts, "text", "ids", loader), "text", "n", loader)
    rows = {r["i"]: r for r in vocabulary.with_decoded(rows, "ids", "shown", loader).collect()}
    model = loader()
    for i, text in enumerate(TEXTS):
        if text is None:
            assert rows[i]["ids"] is None and rows[i]["n"] is None and rows[i]["shown"] is None
        else:
            assert rows[i]["ids"] == list(model.encode([text])[0]) and rows[i]["n"] == len(rows[i]["ids"])
            if kind != "model":
                assert rows[i]["shown"] == text


def test_a_batch_is_encoded_in_blocks(spark):
    """However many texts an Arrow batch has, ids of a bounded number of characters (or ids) are held at a time."""

    class Small:
        def encode(self, texts):
            assert sum(map(len, texts)) <= 2 * tokenize.TEXT_AT_ONCE
            return [[1] * len(t) for t in texts]

        def decode(self, rows):
            assert sum(map(len, rows)) <= 2 * vocabulary.IDS_AT_ONCE
            return ["x" * len(r) for r in rows]

    rows = spark.range(0, 2000, 1, 1).select("id", F.when(F.col("id") % 7 != 0, F.repeat(F.lit("x"), 2000)).alias("text"))
    rows = vocabulary.with_token_counts(vocabulary.with_ids(rows, "text", "ids", Small), "text", "n", Small)
    right = (F.col("shown").eqNullSafe(F.col("text"))) & F.col("n").eqNullSafe(F.length("text"))
    assert vocabulary.with_decoded(rows, "ids", "shown", Small).where(right).count() == 2000


@pytest.mark.parametrize("kind", sorted(FILES))
@pytest.mark.parametrize("size,overlap", [(1, 0), (7, 3), (50, 49), (10_000, 0)])
def test_chunks_are_stretches_of_the_text(texts, kind, size, overlap):
    rows = vocabulary.chunk_by_vocabulary(texts, FILES[kind](), size=size, overlap=overlap).collect()
    starts = FILES[kind]()().starts
    for i, text in enumerate(TEXTS):
        mine = sorted((r for r in rows if r["i"] == i), key=lambda r: r["chunk_no"])
        assert [r["chunk_no"] for r in mine] == list(range(len(mine)))
        if not text:
            assert mine == []
            continue
        assert all(r["chunk"] == text[r["start"] : r["end"]] for r in mine)
        assert mine[0]["start"] == 0 and mine[-1]["end"] == len(text)
        assert all(b["start"] <= a["end"] for a, b in zip(mine, mine[1:]))  # nothing is lost between them
        assert len(mine) == len(vocabulary.window_starts(len(starts([text])[0]), size, overlap))


def test_windows_as_the_native_chunks(spark, texts):
    """The same number of windows, for equal numbers of tokens, as `chunk_tokens` cuts."""
    for n in (0, 1, 9, 10, 11, 100, 101):
        native = chunk.chunk_tokens(spark.createDataFrame([("a " * n,)], "text string"), size=10, overlap=3).count()
        assert native == len(vocabulary.window_starts(n, 10, 3))
    with pytest.raises(ValueError):
        vocabulary.chunk_by_vocabulary(texts, FILES["json"](), size=3, overlap=3)
    with pytest.raises(ValueError):
        vocabulary.from_file("/nowhere/ranks.tiktoken")


def test_ids_for_training(texts):
    rows = tokenize.tokenize_rows(texts.where("text is not null"), "text", max_length=5, encoder=vocabulary.encoder(FILES["json"]())).collect()
    assert max(len(r["input_ids"]) for r in rows) == 5


# --- packing -------------------------------------------------------------------------------------


def brute_force(lengths, capacity):
    """Space left in each bin, by the definition: longest first, into the fullest bin that holds it."""
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [(space, i) for i, space in enumerate(bins) if space >= n]
        if fit:
            bins[min(fit)[1]] -= n
        else:
            bins.append(capacity - n)
    return sorted(bins)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 60).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=120))))
def test_plan_is_best_fit_decreasing(case):
    capacity, lengths = case
    histogram = {n: lengths.count(n) for n in lengths}
    bins, rows = {}, {n: [] for n in histogram}
    for length, first, count, first_bin, offset in packing.plan(histogram, capacity):
        for k in range(count):
            bins.setdefault(first_bin + k, []).append((offset, length))
            rows[length].append(first + k)
    assert all(sorted(rows[n]) == list(range(histogram[n])) for n in histogram)
    for placed in bins.values():
        ends = [0, *(o + n for o, n in sorted(placed))]
        assert [o for o, _ in sorted(placed)] == ends[:-1] and ends[-1] <= capacity
    assert sorted(capacity - sum(n for _, n in p) for p in bins.values()) == brute_force(lengths, capacity)


def test_plan_grows_with_lengths_not_rows():
    many = packing.plan({n: 10**12 + n for n in range(1, 2049)}, 2048)
    assert len(many) < 100_000


def test_packed_rows_are_whole(spark):
    rng = random.Random(8)
    rows = [(i % 900, [i] * rng.choice([1, 2, 31, 32, 32, 17])) for i in range(1000)] + [(5000, []), (5001, None)]
    frame = spark.createDataFrame(rows, "k int, input_ids array<int>").repartition(6)
    packed = packing.pack_sequences(frame, "k", capacity=32, pad_id=-9).collect()
    lengths = [len(v) for _, v in rows if v]
    assert len(packed) == len(brute_force(lengths, 32)) and len({r["sequence"] for r in packed}) == len(packed)
    found = []
    for r in packed:
        assert all(len(r[c]) == 32 for c in ("input_ids", "attention_mask", "segment_ids", "position_ids"))
        at = 0
        for number, (key, n) in enumerate(zip(r["keys"], r["lengths"])):
            part = slice(at, at + n)
            found.append((key, tuple(r["input_ids"][part])))
            assert set(r["segment_ids"][part]) == {number + 1} and r["position_ids"][part] == list(range(n))
            at += n
        assert r["input_ids"][at:] == [-9] * (32 - at) and r["attention_mask"] == [1] * at + [0] * (32 - at)
    assert sorted(found) == sorted((k, tuple(v)) for k, v in rows if v)
    with pytest.raises(ValueError):
        packing.pack_sequences(frame, "k", capacity=31)
    assert packing.pack_sequences(frame.limit(0), "k").collect() == []


def test_fill_rate(spark):
    frame = spark.createDataFrame([(1, [1] * 6), (2, [2] * 2)], "k int, input_ids array<int>")
    assert packing.fill_rate(packing.pack_sequences(frame, "k", capacity=8)) == 1.0
    assert packing.fill_rate(packing.pack_sequences(frame, "k", capacity=16)) == 0.5


# --- batches -------------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 120), st.integers(1, 9))
def test_cuts(lengths, budget, most):
    lengths = sorted(lengths, reverse=True)
    cuts = batches.budget_cuts(lengths, budget, most)
    assert [x for a, b in cuts for x in range(a, b)] == list(range(len(lengths)))
    for k, (a, b) in enumerate(cuts):
        assert b - a == 1 or ((b - a) * max(1, lengths[a]) <= budget and b - a <= most)
        if b < len(lengths) and b - a < most:
            assert (b - a + 1) * max(1, lengths[a]) > budget  # no batch could have taken one more


def test_answers_stand_in_their_rows(spark):
    rng = random.Random(3)
    rows = [(i, None if i % 17 == 0 else "w " * rng.choice([1, 2, 40, 90])) for i in range(300)]
    frame = spark.createDataFrame(rows, "i int, prompt string").repartition(3)
    order = [r["i"] for r in frame.collect()]

    def load():
        def predict(prompts):
            if sum(len(p) for p in prompts) > 400:
                raise MemoryError("too many")
            return [f"{len(p)}" for p in prompts]

        return predict

    done = batches.generate_within_budget(frame, "prompt", "answer", load, budget=256)
    out = done.collect()
    assert [r["i"] for r in out] == order
    for r in out:
        if r["prompt"] is None:
            assert (r["answer"], r["status"], r["batch"]) == (None, "null prompt", None)
        else:
            assert r["answer"] == str(len(r["prompt"])) and r["status"] == "ok"
            assert r["batch"]["rows"] == 1 or r["batch"]["rows"] * r["batch"]["longest"] <= 256
    shape = batches.padding(done).first()
    assert shape["tokens"] == sum(len(p.split()) for _, p in rows if p) and 0 <= shape["waste"] < 0.1
    assert batches.generate_within_budget(frame.limit(0), "prompt", "answer", load).collect() == []
    assert done.select(F.col("batch.tokens")).columns == ["tokens"]
