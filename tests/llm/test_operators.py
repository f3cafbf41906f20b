"""Each operator against brute force, a library, or labels it has not seen."""

import bisect
import hashlib
import importlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F

import compare
from promptloom.llm import (
    ann, decontaminate, langid, licenses, pieces, quality, repeats, shards, simhash, warc,
)
from promptloom.llm.queries import ORACLES, QUERIES, tokenizer_path
from promptloom.session import materialize

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


# --- WARC ----------------------------------------------------------------------------------------

FAKE = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:999>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


@pytest.mark.parametrize("split_bytes", ["20000", "128m"])
def test_records_inside_payloads_are_rejected(spark, split_bytes):
    """Payloads hold magics and whole records, some over several input splits."""
    texts = [FAKE, FAKE * 50, "a" + FAKE + "WARC/1.0\r\n", "", None, "x" * 200, "x" * 200, "é" * 100, "WARC/1.0\r\n",
             "\r\n\r\n", "z" * 70000 + FAKE + "y" * 70000, FAKE * 50, "\x00" * 150, "x" * 99, "x" * 99]
    rows = [(i, f"u\n{i}", x) for i, x in enumerate(texts)]
    rows += [(None, "n", "x" * 200), (5, "again", "x" * 200), (None, None, None)]
    rows += [(100 + i, f"u{i}", "p" * (i % 300)) for i in range(600)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split_bytes)
    try:
        got = [tuple(r) for r in warc.archive_round_trip(pages).collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(page, first.get(body, page))
    want = []
    for page, _, html in rows:
        body = (html or "").encode()
        target = first.get(body)
        again = target is not None and target != page
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", target if again else None))
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_payloads_come_back(spark, tmp_path):
    rows = [(1, "u", FAKE * 3), (2, "v", "plain"), (3, "w", "")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "w"))
    got = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, str(tmp_path / "w"), payload=True).collect()}
    assert got == {f"<urn:page:{i}>": text for i, _, text in rows}


# --- quality, language ---------------------------------------------------------------------------


def test_quality_on_rows_held_out(spark):
    found = {r["doc_id"]: r for r in QUERIES["op2_quality"](spark, MIDDLE).collect()}
    known = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{MIDDLE}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in found.items())
    unseen = [(found[i]["predicted"], q) for i, q in known.items() if found[i]["held_out"]]
    assert np.mean([a == b for a, b in unseen]) >= 0.95
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found.values())


def test_training_order_and_blocks():
    """Blocks of texts are an optimisation only: each text scores as by itself."""
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["good", "words", "here", "***", "A1"]) for _ in range(rng.randrange(60))).encode() for _ in range(300)]
    model = quality.train(texts, np.array([b"***" not in t for t in texts], float))
    together = model.score(texts)
    assert np.allclose(together, [model.score([t])[0] for t in texts])
    assert np.mean((together >= 0.5) == np.array([b"***" not in t for t in texts])) > 0.95


def test_quality_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality.quality_scores(docs, none).collect()} == {1.0}
    one = spark.createDataFrame([(0, 1), (1, 1), (0, 0), (None, 1), (3, None)], "doc_id long, quality int")
    assert quality.quality_scores(docs, one).where("score > 0.5").count() == 200


def test_training_sample_is_bounded(spark, docs):
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    model = quality.fit(docs, labels, max_rows=20)
    assert model.weights is not None


def test_language_on_rows_held_out(spark):
    found = {r["doc_id"]: r for r in QUERIES["op3_language"](spark, MIDDLE).collect()}
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in found.items())
    unseen = [i for i, r in found.items() if r["held_out"]]
    assert np.mean([found[i]["lang_pred"] == docs[i]["lang"] for i in unseen]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_long_texts_count_whole():
    """The language of a long text is that of most of it, not of its start."""
    content = {"en": b"the quick brown fox and the lazy dog " * 9, "de": b"der schnelle braune Fuchs und der faule Hund " * 9}
    text = "the quick brown fox " * 10 + "und der schnelle braune Fuchs der faule Hund " * 2000
    assert langid.Identifier(content).identify(text)[0] == "de"


# --- pieces --------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizers():
    vocabulary, reachable = pieces.load_vocabulary(tokenizer_path())
    return pieces.Pieces(vocabulary, reachable), sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())


def test_pieces_as_the_library(tokenizers, docs):
    own, library = tokenizers
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "▁", "a", "the", "ing", " ", "日本", "é", "é", "①", "\x00", "😀", "   ", "1234", "!!",
             "-----", "=====", "İ", "\r\n", "�", "thlyanble"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += [" " * k for k in range(40)] + ["-" * k for k in range(70)] + ["a" * 3000, "\n" * 500, " " * 3000 + "x", "ab" * 2000]
    texts += [r["text"] for r in docs.select("text").collect()]
    for text in texts:
        ids = library.encode(text)
        assert own.encode(text) == ids and own.decode(ids) == library.decode(ids), text[:80]


def test_backtracking_where_longest_matches_fail(tokenizers):
    """All single words that take a step back give what merging gives."""
    own, _ = tokenizers
    rng = random.Random(4)
    short = [p for p in own.score if 2 <= len(p) <= 5 and p.isascii()]
    back = 0
    for _ in range(3000):
        word = rng.choice(short) + rng.choice(short) + rng.choice(short)
        greedy = [p for _, p in own.automaton.iter_long(word)]
        merged = own.merge(word)
        assert own.tokens(word) == merged
        back += greedy != merged
    assert back > 300


def test_memories_are_bounded():
    made = pieces.Memory(len, 10)
    assert [made[str(i)] for i in range(100)] == [len(str(i)) for i in range(100)] and len(made) + len(made.older) <= 20


def test_op4_query(spark, tokenizers):
    _, library = tokenizers
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op4_pieces"](spark, SMALL).collect():
        ids = library.encode(texts[r["doc_id"]]) + [2]
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


# --- repeats -------------------------------------------------------------------------------------


def covered(texts, length=200):
    counts = Counter(t[s : s + length] for t in texts for s in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for s in range(len(t) - length + 1):
            if counts[t[s : s + length]] > 1:
                gone[s : s + length] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdé ") for _ in range(900)) for _ in range(6)]

    def near(text):
        text = list(text)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        return "".join(text)

    out = []
    for _ in range(150):
        kind, text, a = rng.random(), rng.choice(base), rng.randrange(600)
        if kind < 0.4:
            out.append(near(text))
        elif kind < 0.6:
            out.append("".join(rng.choice("pqr") for _ in range(rng.randint(0, 50))) + text[a : a + rng.randint(150, 300)] + near(rng.choice(base))[: rng.randint(0, 250)])
        elif kind < 0.7:
            out.append("a" * rng.randint(150, 900))
        elif kind < 0.8:
            out.append("line of text number\n" * rng.randint(5, 40))
        else:
            out.append("".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 400))))
    return out + [None, "", "x" * 199, "y" * 200, "y" * 200, "ab" * 400, "m" * 300_000 + base[0]]


@pytest.mark.parametrize("limit", [repeats.BUCKET_LIMIT, 3])
def test_repeats_as_brute_force(spark, limit):
    """Also where every bucket over three contexts is taken apart into hashed windows."""
    texts = repeated_texts()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r)[1:] for r in repeats.deduplicate_bytes(frame, limit=limit).collect()}
    assert [got[i] for i in range(len(texts))] == covered([(t or "").encode() for t in texts])


def test_repeats_of_documents(spark, docs):
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op5_repeats"](spark, SMALL).collect()}
    assert [got[i] for i in texts] == covered(list(texts.values()))


def test_interval_tree_and_offsets_agree(monkeypatch):
    rng = random.Random(5)
    base = "".join(rng.choice("abc") for _ in range(264))
    contexts = set()
    for _ in range(80):
        text = list(base)
        for _ in range(rng.randrange(5)):
            text[rng.choice([*range(60), *range(124, 264)])] = rng.choice("xy")
        contexts.add(("".join(text).encode()[rng.randrange(30) :]))
    contexts = [(c, len(c) - 204) for c in contexts]
    by_tree = repeats.extend(contexts, 200)
    monkeypatch.setattr(repeats, "TREE_LIMIT", 2)
    # The anchor's windows end 200 bytes behind it at most.
    assert repeats.extend(contexts, 200) == [x and (x[0], min(x[1], 200)) for x in by_tree]
    assert list(repeats.lcp_intervals([2, 0, 3, 3])) == [(2, 0, 1), (3, 2, 4), (0, 0, 4)]


def test_whole_characters_stay(spark):
    shared = "é" * 150
    rows = [(1, "è" + shared, "x"), (2, "ê" + shared, "y")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    out = repeats.without_repeats(frame)
    assert out.columns == frame.columns and {r["text"] for r in out.collect()} == {"è", "ê"}


# --- neighbours ----------------------------------------------------------------------------------


def exact_neighbours(rows, k=5, every=50):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    norm = np.sqrt((v * v).sum(1))
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        score = (v * v[i]).sum(1) / (norm * norm[i])
        out[int(ids[i])] = [(int(ids[j]), score[j]) for j in np.lexsort((ids, -score)) if ids[j] != ids[i]][:k]
    return out


def test_recall(spark):
    frame = spark.read.parquet(f"{MIDDLE}/embeddings.parquet")
    want = exact_neighbours([(r["vec_id"], r["embedding"]) for r in frame.collect()])
    got = defaultdict(list)
    for r in QUERIES["op6_neighbours"](spark, MIDDLE).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want) and all(sorted(x[0] for x in g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = sum(len({x[1] for x in got[q]} & {x[0] for x in w}) for q, w in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_equal_vectors_and_ties(spark):
    """A third of the rows are one vector; every query gets the smallest ids of it."""
    rng = np.random.default_rng(1)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)] + [(1000 + i, rng.normal(size=3).tolist()) for i in range(400)]
    want = exact_neighbours(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = defaultdict(list)
    for r in ann.nearest(frame).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    for q in range(0, 300, 50):
        assert [x[1] for x in sorted(got[q])] == [x[0] for x in want[q]]
    for q, found in got.items():
        exact = dict(exact_neighbours(rows, k=700)[q])
        assert all(s == pytest.approx(exact[i], abs=1e-12) for _, i, s in found)


def test_ties_of_differing_vectors(spark):
    """Many distinct vectors tie with the last places: the smallest ids win, in any order of the rows."""
    rng = np.random.default_rng(3)
    scaled = np.ldexp(np.array([1.0, 2.0, 3.0]), rng.permutation(60)[:, None] - 30)
    binary = np.array([[i >> b & 1 for b in range(10)] for i in range(1, 1024)], float)
    int8 = np.unique(rng.integers(-2, 3, (1500, 4)), axis=0).astype(float)
    int8 = int8[np.abs(int8).max(axis=1) > 0]
    for vectors in (scaled, binary, int8):
        rows = list(zip(rng.permutation(len(vectors)).tolist(), vectors.tolist()))
        ids = np.array([r[0] for r in rows])
        for query, want in exact_neighbours(rows, k=6, every=7).items():
            asked = vectors[ids == query]
            others = np.flatnonzero(ids != query)
            _, cols, score = ann._best(asked, vectors[others], ids[others], 6)
            assert list(zip(ids[others][cols].tolist(), score)) == want
    rows = [(i, v) for i, v in enumerate(scaled.tolist())]
    rng.shuffle(rows)
    found = ann.nearest(spark.createDataFrame([(int(i), list(v)) for i, v in rows], "vec_id long, embedding array<double>"))
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in found.collect()}
    assert [got[0, k] for k in range(1, 6)] == [1, 2, 3, 4, 5] and [got[50, k] for k in range(1, 6)] == [0, 1, 2, 3, 4]


def test_all_leaves_find_everything():
    rng = np.random.default_rng(2)
    unit = ann._unit(rng.normal(size=(2000, 8)))
    tree = ann.grow(unit, 2)
    assert sorted(tree.visit(unit[0], tree.leaves)) == list(range(tree.leaves))
    assert tree.visit(unit[0], 3) == tree.visit(unit[0], tree.leaves)[:3]


# --- licenses ------------------------------------------------------------------------------------


def test_planted_licenses(spark, docs):
    words = " ".join(r["text"] for r in docs.limit(30).collect()).split()
    rng = random.Random(2)
    rows = []
    for name, text in licenses.TEMPLATES.items():
        for _ in range(8):
            notice = text.split()
            if len(notice) > 60:
                for _ in range(2):
                    notice[rng.randrange(len(notice))] = "foo"
            start = rng.randrange(3000)
            rows.append((len(rows), name, " ".join(words[start : start + rng.randrange(300)] + notice + words[:200])))
    frame = spark.createDataFrame(rows, "doc_id long, name string, text string")
    found = {(r["doc_id"], r["license"]) for r in licenses.scan_licenses(frame).collect()}
    assert all((i, name) in found for i, name, _ in rows)


def test_licenses_as_brute_force(spark, docs):
    def shingles(text):
        return set(licenses.shingles(licenses.words_of(text)).tolist())

    templates = {name: shingles(text) for name, text in licenses.TEMPLATES.items()}
    want = {
        (r["doc_id"], name)
        for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
        for name, t in templates.items() if len(shingles(r["text"]) & t) >= 0.8 * len(t)
    }
    got = {(r["doc_id"], r["license"]) for r in QUERIES["op7_licenses"](spark, MIDDLE).collect()}
    assert got == want and got


def test_bands_keep_their_promise():
    assert 1 - (1 - 4 / 6) ** licenses.bands_for(4, 6, 0.8) >= licenses.COLLISION
    assert licenses.bands_for(1, 6) >= licenses.bands_for(4, 6)


# --- decontamination -----------------------------------------------------------------------------

QUESTION = "Alice has 12 apples and gives Bob 5 apples. How many km does Alice walk after 12 days if it is 3.5 km away?"


def test_reparameterised_questions(spark):
    bench = spark.createDataFrame([(1, QUESTION), (1, QUESTION), (2, "too short"), (3, None)], "item_id long, text string")
    texts = {
        1: "x. Carol has 30 apples and gives Dave 7 apples. How many km does Carol walk after 30 days if it is 2 miles away? and more",
        2: QUESTION.replace("after 12", "after 13"),  # one value of the item stands for two
        3: QUESTION.replace("gives Bob", "gives Alice"),  # two names have become one
        4: "nothing to see here, friend 12 km",
        5: "so " + QUESTION.upper(),
        6: "Yes. " + QUESTION + " And more words that follow it.",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["n_changed"] for r in decontaminate.leaks(docs, bench).collect()}
    assert set(got) >= {1, 6} and got[6] == 0 and got[1] > 0 and not set(got) & {2, 3, 4}
    many = decontaminate.leaks(docs, bench, windows_per_block=3)
    assert {r["doc_id"]: r["n_changed"] for r in many.collect()} == got


def test_benchmark_passages(spark):
    """Every document that holds an item as it is, and no other."""
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    items = spark.read.parquet(f"{MIDDLE}/benchmark.parquet").collect()
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"].lower() in d["text"].lower()}
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op8_decontaminate"](spark, MIDDLE).collect()}
    assert got == want and got


def test_redrawn_values_may_be_equal(spark):
    """Two numbers or units of an item that became one value by chance are no clash."""
    bench = spark.createDataFrame([(1, QUESTION), (2, "The bar is 30 cm long and the rope is 2 km long, so which one is longer and why?")], "item_id long, text string")
    texts = {
        1: "x. Carol has 30 apples and gives Dave 7 apples. How many km does Carol walk after 30 days if it is 7 miles away? and more",
        2: "ok. The bar is 40 mm long and the rope is 40 mm long, so which one is longer and why?",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()} == {(1, 1), (2, 2)}


def test_copies_of_sums_and_lists(spark):
    """Windows of placeholders alone match by their values: verbatim copies are found, other values are not."""
    items = {
        1: "Compute 3 + 5 + 7 + 9 + 11 + 13",
        2: "What is 12 + 6 * 234 - 111 / 7 + 88?",
        3: "The Lord Of The Rings Was Written By John Ronald Reuel Tolkien",
    }
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    texts = {
        1: f"Some words. {items[1]} and more of them.",
        2: f"Then, as they asked: {items[2]} Nobody knew.",
        3: f"As we read, {items[3]}, and so on.",
        4: f"it says {items[3].lower()} in small letters",
        5: "Compute 4 + 6 + 8 + 10 + 12 + 14 and 3 + 5 + 7",
        6: "What is 13 + 6 * 235 - 111 / 8 + 88?",
        7: "The King Of The Hills Was Painted By Mary Ann Sue Miller",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for options in ({}, {"windows_per_block": 3}):
        got = {(r["doc_id"], r["item_id"], r["coverage"], r["n_changed"]) for r in decontaminate.leaks(docs, bench, **options).collect()}
        assert {x[:2] for x in got} == {(1, 1), (2, 2), (3, 3), (4, 3)}
        assert all(x[2:] == (1.0, 0) for x in got)
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs, bench).orderBy("doc_id").collect()] == [5, 6, 7]


def test_large_benchmark_reads_documents_once(spark, tmp_path, monkeypatch):
    """Of a benchmark that is too large to be broadcast only bits are, and results are as with one that is not."""
    rng = random.Random(8)
    words = [f"{a}{b}" for a in "bdfgklmnprst" for b in ("al", "ek", "in", "or", "ush")]
    items = [(i, " ".join(rng.choices([*words, "Alice", "7", "12 km"], k=30))) for i in range(20)] + [(20, QUESTION), (20, QUESTION)]
    texts = [" ".join(rng.choices(words, k=80)) for _ in range(30)]
    texts += [f"{texts[i]}. {x} and again {x.replace('7', '9').replace('Alice', 'Carol')} {x[:60]}" for i, x in items]
    bench = spark.createDataFrame(items, "item_id long, text string")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    plans = []

    def noted(df, name="stage"):
        if name == "matches":
            plans.append(df._jdf.queryExecution().toString().partition("Physical Plan")[2])
        return materialize(df, name)

    monkeypatch.setattr(decontaminate, "materialize", noted)
    whole = sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    assert {(r[0], r[2]) for r in whole} == {(30 + k, i) for k, (i, _) in enumerate(items)} and any(r[4] for r in whole)
    assert sorted(map(tuple, decontaminate.leaks(docs, bench, windows_per_block=100).collect())) == whole
    assert [p.count("ReadSchema: struct<doc_id") for p in plans] == [1, 1]


def test_raw_tokens_of_a_window(spark):
    """Cut out of the text, they are what the text split whole holds there."""
    texts = ["One Two 3.5 km ΟΔΟΣ and İstanbul, as SHE told Bob. Yes", "a b c d e", "12 13 14 15 16 17"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").select(decontaminate._cleaned(F.col("text")).alias("cleaned"))
    raw = decontaminate._raw_tokens()
    places = frame.select("cleaned", raw.alias("raw"), F.explode(F.sequence(F.lit(0), F.size(raw) - 5)).alias("at"))
    rows = places.select(F.slice("raw", F.col("at") + 1, 5).alias("want"), decontaminate._raw_window(F.col("at"), 5).alias("got")).collect()
    assert len(rows) >= 9 and all(r["want"] == r["got"] for r in rows)


def test_decontamination_is_native(spark, docs):
    plan = decontaminate.leaks(docs, spark.read.parquet(f"{SMALL}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


# --- SimHash -------------------------------------------------------------------------------------


def grouped(prints, distance=3):
    values = np.array(prints, dtype=np.uint64)
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            parent[find(int(j))] = find(i)
    return [find(i) for i in range(len(values))]


@pytest.mark.parametrize("limit", [simhash.BUCKET_LIMIT, 2])
def test_components_as_brute_force(spark, limit):
    """Fingerprints in clusters of a few bits; with a limit of 2, nearly all buckets take the way of whole balls."""
    rng = random.Random(6)
    prints = []
    for _ in range(25):
        center = rng.getrandbits(64)
        for _ in range(12):
            center ^= sum(1 << b for b in rng.sample(range(64), rng.randrange(5)))
            prints.append(center)
    signed = [p - (1 << 64) if p >= 1 << 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in set(signed)], "fp long").repartition(4)
    from promptloom.llm.common import components

    roots = {r["node"]: r["root"] for r in components(simhash.links(distinct, 3, limit)).collect()}
    order = list(dict.fromkeys(signed))
    label = grouped([p & ((1 << 64) - 1) for p in order])
    want = {frozenset(p for p, x in zip(order, label) if x == c) for c in set(label)}
    got = defaultdict(set)
    for p in order:
        got[roots.get(p, p)].add(p)
    assert {frozenset(g) for g in got.values()} == want


def test_simhash_query(spark):
    texts = {r["doc_id"]: r["text"].encode() for r in spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()}
    rows = QUERIES["op9_simhash"](spark, MIDDLE).collect()
    assert all(r["fingerprint"] == f"{simhash.fingerprint(texts[r['doc_id']]):016x}" for r in rows)
    label = grouped([int(r["fingerprint"], 16) for r in rows])
    smallest = defaultdict(lambda: 1 << 62)
    for r, c in zip(rows, label):
        smallest[c] = min(smallest[c], r["doc_id"])
    assert all(r["component_id"] == smallest[c] for r, c in zip(rows, label))


def test_fingerprint_is_xxh64_with_seed_42(spark):
    one = spark.sql("SELECT xxhash64('hello big world')").first()[0]
    assert simhash.fingerprint(b"Hello\tBIG  world\n") == one & ((1 << 64) - 1)
    assert simhash.fingerprint(b" \n") == simhash.fingerprint(b"") == 0


# --- shards --------------------------------------------------------------------------------------


def smallest_capacity(sizes, n):
    def fits(capacity):
        used, filled = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if filled + s > capacity:
                used, filled = used + 1, 0
            filled += s
        return used <= n

    low, high = 1, sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("n,copies", [(40, 0), (7, 0), (5, 300), (1, 10)])
def test_shards_are_as_even_as_can_be(spark, docs, n, copies):
    """Also where copies of one text are more than a shard's share."""
    rows = docs.select("doc_id", "text")
    if copies:
        rows = rows.union(spark.range(copies).select(F.col("id") + 10_000, F.lit("one text of many copies " * 40)))
    got = shards.shard_documents(rows, n).collect()
    texts = {r["doc_id"]: r["text"] for r in rows.collect()}
    by_shard, home = defaultdict(list), {}
    for r in got:
        assert r["size"] == len(texts[r["doc_id"]].encode()) + 16 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode())
        assert home.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"] and 0 <= r["shard"] < n and r["law"] == "bytes"
        by_shard[r["shard"]].append(r)
    assert len(got) == len(texts) and all(sorted(r["slot"] for r in g) == list(range(len(g))) for g in by_shard.values())
    groups = defaultdict(int)
    for text in texts.values():
        groups[int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)] += len(text.encode()) + 16
    giant = max(groups.values())
    if giant * n > sum(groups.values()):
        rest = [s for _, s in sorted(groups.items()) if s < giant]
        assert max(sum(r["size"] for r in g) for g in by_shard.values()) == max(giant, smallest_capacity(rest, n - 1))
    else:
        assert max(sum(r["size"] for r in g) for g in by_shard.values()) == smallest_capacity([s for _, s in sorted(groups.items())], n)


def test_cuts_are_refined(spark, monkeypatch):
    """With four first blocks the cuts have to be looked for inside of them."""
    monkeypatch.setattr(shards, "BLOCK_BITS", 2)
    rng = random.Random(8)
    units = sorted({rng.getrandbits(60) for _ in range(500)})
    sizes = [rng.randrange(1, 1000) for _ in units]
    frame = spark.createDataFrame(list(zip(units, sizes)), "unit long, bytes long")
    cuts = shards.minimax_cuts(frame, 9)
    edges = [0, *(bisect.bisect_left(units, c) for c in cuts), len(units)]
    assert max(sum(sizes[a:b]) for a, b in zip(edges, edges[1:])) == smallest_capacity(sizes, 9)


# --- registry ------------------------------------------------------------------------------------


def test_every_operator_has_its_query():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert {n.split("_")[0] for n in QUERIES if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) <= set(names) and "pipeline" in names and set(ORACLES) <= set(entry.oracle_sql())


def test_queries_as_sql(spark):
    duck = compare.connect(MIDDLE)
    for name, sql in ORACLES.items():
        assert compare.difference(compare.spark_rows(QUERIES[name](spark, MIDDLE)), compare.duckdb_rows(duck, sql)) is None
