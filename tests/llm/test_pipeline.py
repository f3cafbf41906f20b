"""The pipeline, stage by stage, against brute force over what each stage was given."""

import hashlib
from collections import defaultdict

import numpy as np
import sentencepiece

import corpus_pipeline
from promptloom.llm import simhash
from promptloom.llm.queries import tokenizer_path
from promptloom.session import materialize

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    given = {"start": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = given[name] = materialize(stage(spark, docs, SF))
    rows = {name: {r["doc_id"]: r for r in frame.collect()} for name, frame in given.items()}

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = rows["quality"]
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert np.mean([i in kept for i in good]) > 0.98 and np.mean([i in kept for i in bad]) < 0.1
    assert all(rows["start"][i] == r for i, r in kept.items())

    prints = {i: np.uint64(simhash.fingerprint(r["text"].encode())) for i, r in kept.items()}
    left = rows["near_duplicates"]
    values = np.array([prints[i] for i in left])
    for i, p in prints.items():
        distances = np.bitwise_count(values ^ p)
        if i in left:
            assert (distances <= 3).sum() == 1  # itself only
    assert sum(len(set(kept) - set(left)) for _ in [0]) > 0

    cut = rows["repeats"]
    assert set(cut) == set(left) and all(len(cut[i]["text"]) == cut[i]["n_chars"] <= len(left[i]["text"]) for i in cut)
    seen: dict = defaultdict(set)
    for i, r in cut.items():
        data = left[i]["text"].encode()
        for s in range(len(data) - 199):
            seen[data[s : s + 200]].add((i, s))
    touched = {i for places in seen.values() if len(places) > 1 for i, _ in places}
    assert {i for i in cut if cut[i]["text"] != left[i]["text"]} <= touched
    assert all(cut[i]["text"] == left[i]["text"] for i in set(cut) - touched)

    items = [r["text"].lower() for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {i for i, r in cut.items() if any(x in r["text"].lower() for x in items)}
    assert set(rows["benchmark"]) == set(cut) - held

    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    assert set(rows["pieces"]) == set(rows["benchmark"])
    assert all(r["n_tokens"] == len(library.encode(rows["benchmark"][i]["text"])) + 1 for i, r in rows["pieces"].items())

    whole = {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {tuple(r) for r in rows["pieces"].values()}


def test_product_holds_the_encoded_texts(spark):
    docs = spark.createDataFrame([(1, "Some plain words, é日本."), (2, None), (None, "")], "doc_id long, text string")
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    rows = {r["doc_id"]: r for r in corpus_pipeline.encoded(spark, docs, SF).collect()}
    for i, text in {1: "Some plain words, é日本.", 2: "", None: ""}.items():
        ids = [int(x) for x in rows[i]["ids"].split(" ")]
        assert ids == library.encode(text) + [2] and len(ids) == rows[i]["n_tokens"]
        assert hashlib.sha256(rows[i]["ids"].encode()).hexdigest() == rows[i]["ids_sha256"]
