"""Sketches, the trie and the manifest against brute force, and probes of earlier operators."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from promptloom.llm import ann, common, decontaminate, langid, licenses, merkle, quality, repeats, sketches, trie, warc
from promptloom.llm.queries import QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- sketches ------------------------------------------------------------------------------------


def paragraphs(text):
    n = sketches.STRETCH
    return {p for line in text.split("\n") for p in (line[i : i + n] for i in range(0, len(line), n)) if p}


def likeness(a, b):
    return 1.0 if not a | b else len(a & b) / len(a | b)


def check_fingerprints(docs):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()))
    found = {r["doc_id"]: r for r in sketches.fingerprint_documents(docs).collect()}
    assert len(found) == len(rows)
    by_text = {}
    for k, (doc_id, text) in enumerate(rows):
        following, quarter, got = rows[(k + 1) % len(rows)][1], len(text) // 4, found[doc_id]
        edited = text[: len(text) - quarter] + following[:quarter]
        assert got["n_chars"] == len(text) and got["edited_sha256"] == sha(edited)
        assert got["near_edited"] == pytest.approx(likeness(paragraphs(text), paragraphs(edited)))
        assert got["near_next"] == pytest.approx(likeness(paragraphs(text), paragraphs(following)))
        by_text.setdefault(text, set()).add(got["fingerprint"])
        by_text.setdefault(edited, set()).add(got["edited_fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())
    assert len({tuple(p)[0] for p in by_text.values()}) >= len({frozenset(paragraphs(t)) for t in by_text}) - 1


def test_fingerprints(spark, docs):
    check_fingerprints(docs)


def test_fingerprints_of_odd_texts(spark):
    texts = ["", None, "\n\n", "one line", "a\nb\nc\nd", "a\nb\nc\ne", "é\U0001f600" * 900, "x" * 5000, "same\n" * 300, "a\nb\nc\nd"]
    check_fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    check_fingerprints(spark.createDataFrame([(7, "alone\nwith itself")], "doc_id long, text string"))


def test_peeling_recovers_both_sides(spark):
    """Lists of every size of difference, up to thousands: all digests come back, by side, and nothing else."""
    rng = random.Random(5)
    rows, want = [], {}
    for k, (both, left, right) in enumerate([(0, 0, 0), (50, 0, 0), (0, 1, 0), (9, 2, 3), (100, 20, 20), (0, 400, 300), (5000, 3000, 1), (0, 0, 9)]):
        digests = list({rng.getrandbits(64) - (1 << 63) for _ in range(both + left + right)})
        a, b = digests[: both + left], digests[:both] + digests[both + left :]
        rows.append((k, rng.sample(a, len(a)), b))
        want[k] = {(d, 1) for d in digests[both : both + left]} | {(d, -1) for d in digests[both + left :]}
    pairs = spark.createDataFrame(rows, "k int, a array<long>, b array<long>")
    got = {k: set() for k in want}
    for r in sketches.differences(pairs, ["k"], "a", "b").collect():
        assert (r["digest"], r["side"]) not in got[r["k"]]
        got[r["k"]].add((r["digest"], r["side"]))
    assert got == want


# --- trie ----------------------------------------------------------------------------------------


def brute_trie(rows, every=20, heads=4):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    own = {c: [(r[2] or "", r[3] or "") for r in sorted(v, key=lambda r: (r[1] is not None, r[1] or 0))] for c, v in by.items()}
    rebuilt = {c: own.get(c - c % every, [])[: (h := zlib.crc32(str(c).encode()) % heads)] + t[h:] for c, t in own.items()}
    members, children, sums = {}, {}, {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        below = [sums[c] for c in children.get(node, ())]
        sums[node] = (sum(b[0] for b in below) if below else 1, (len(members[node]) - 1) * words + sum(b[1] for b in below))
    return {
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, ())), *sums[node],
         sha(",".join(map(str, sorted(c for c in m if len(rebuilt[c]) == len(node))))))
        for node, m in members.items()
    }


@pytest.mark.parametrize("band", [64, 5, 2])
def test_trie(spark, band):
    rng = random.Random(band)
    rows = []
    for c in range(90):
        n = rng.choice([1, 2, 3, 5, 30 if c % 30 == 0 else 4])
        rows += [(c, t, rng.choice(["user", None]), rng.choice(["a b", "", None, "a\tb  c"])) for t in range(n)]
    rows += [(c, None, "user", "first") for c in range(0, 90, 4)] + [(40, 100 + t, "user", "same words") for t in range(40)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash"))
    got = [tuple(r) for r in trie.conversation_trie(frame.repartition(4), band=band).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_trie(rows)


def test_trie_of_odd_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.conversation_trie(spark.createDataFrame([], schema)).collect() == []
    rows = [(None, 0, "user", "no conversation"), (3, 0, None, None)]
    got = {tuple(r) for r in trie.conversation_trie(spark.createDataFrame(rows, schema)).collect()}
    assert got == brute_trie([r for r in rows if r[0] is not None])


# --- manifest ------------------------------------------------------------------------------------


def brute_manifest(rows):
    def of(r, text):
        fields = [r[0], r[1], r[2], r[3], text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def climb(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(at):
                run = nodes[p // 16 * 16 : p // 16 * 16 + 16]
                paths[i].append((run[: p % 16], run[p % 16 + 1 :]))
            at = [p // 16 for p in at]
            nodes = [sha("".join(nodes[k : k + 16])) for k in range(0, len(nodes), 16)]
        return nodes[0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, of(r, r[4])))
        trees[g] = climb([of(r, r[4]) for r in groups[g]])
    root, tops = climb([trees[g][0] for g in names])
    out = []
    for g, top in zip(names, tops):
        for r, path in zip(groups[g], trees[g][1]):
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            folded = of(r, text)
            for left, right in path + top:
                folded = sha("".join([*left, folded, *right]))
            proof = sha("".join(x for left, right in path + top for x in left + right))
            out.append((r[0], of(r, r[4]), trees[g][0], root, proof, folded, folded == root))
    return out


@pytest.mark.parametrize("sizes", [[1], [2], [300, 1, 16, 17, 0], [1] * 40])
def test_manifest(spark, sizes):
    rows, k = [], 0
    for g, n in enumerate(sizes):
        for _ in range(n):
            k += 1
            rows.append((k if k % 7 else None, [None, "", "é", "B", "b"][g % 5] if g < 5 else f"s{g}", "en" if k % 3 else None, k if k % 4 else None,
                         ["UPPER", "lower", None, "", "Éa"][k % 5]))
    rows += rows[:3]
    frame = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = [tuple(r) for r in merkle.verify_documents(frame.withColumn("pos", F.lit(1)).repartition(5)).collect()]
    assert sorted(got, key=repr) == sorted(brute_manifest(rows), key=repr)


def test_manifest_of_no_rows(spark, docs):
    assert merkle.verify_documents(docs.limit(0)).collect() == []


@pytest.mark.parametrize("build", [sketches.fingerprint_documents, merkle.verify_documents])
def test_edge_rows(spark, edge, build):
    out = build(edge).collect()
    assert len(out) == 12
    assert sorted(map(repr, out)) == sorted(map(repr, build(edge.repartition(5)).collect()))
    assert build(edge.limit(0)).collect() == []


# --- probes of earlier operators -----------------------------------------------------------------


def test_runs_over_the_limit_inside_a_batch():
    batch = pa.RecordBatch.from_arrays([pa.array([1] * 3 + [2] * 900 + [3] * 2 + [4])], names=["k"])
    got = [(c[0].tolist(), crowded) for c, crowded in common.runs(iter([batch]), 0, 200)]
    assert got == [([1] * 3 + [3] * 2, False), ([2] * 900, True), ([4], False)]


@pytest.mark.parametrize("rows_in_batch", [1, 2, 10_000])
def test_crowded_run_with_a_border_between_copies(spark, monkeypatch, rows_in_batch):
    """Two copies of one text on two sides of a piece's border are repeats, and a text that stands once is none."""
    monkeypatch.setattr(repeats, "RUN_LIMIT", 0)
    rng = random.Random(2)
    text, other = ("".join(rng.choice("abcdefgh ") for _ in range(900)) for _ in range(2))
    rows = [(1, text), (2, text), (3, other)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows_in_batch))
    try:
        got = {r["doc_id"]: r["n_removed"] for r in repeats.deduplicate_bytes(frame).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert got == {1: 900, 2: 900, 3: 0}


def test_language_behind_a_shared_banner(spark):
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet")
    banner = "This text is given for general information only and may change at any time without notice to its readers. " * 4
    under = docs.withColumn("text", F.concat(F.lit(banner), "text"))
    found = langid.identify_languages(under, langid.dictionaries(under)).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out())
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97


def test_training_rows_are_bounded_by_rows_and_bytes(spark, monkeypatch):
    seen = []
    docs = spark.range(30_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("words here "), F.col("id").cast("string")).alias("text"))
    docs = docs.union(docs)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plain = quality.fit(docs, labels, max_rows=400)
    assert plain.weights is not None
    # What the training task gets is what the frame before it holds.
    monkeypatch.setattr(quality, "train", lambda texts, y: (_ for _ in ()).throw(RuntimeError(f"{len(texts)} rows")))
    for options, most in (({"max_rows": 400}, 400), ({"max_rows": 400, "max_bytes": 100}, 7)):
        with pytest.raises(Exception) as error:
            quality.fit(docs, labels, **options)
        seen = [int(n) for n in re.findall(r"(\d+) rows", str(error.value))]
        assert seen and max(seen) <= most


def test_tiny_vector_does_not_spoil_the_tree(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 8)))] + [(3000, [1e-200] * 8), (3001, [1e200] * 8)]
    units = ann._unit(np.array([v for _, v in rows]))
    assert np.isfinite(units).all() and np.allclose((units * units).sum(axis=1), 1)
    assert ann.grow(units, 2).leaves > 100
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(frame).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    hits = 0
    for q, found in got.items():
        score = units @ units[q]
        score[q] = -2
        hits += len(set(np.argsort(-score)[:5].tolist()) & {v for _, v in found})
    assert hits >= 0.9 * 5 * len(got) and len(got) == 61
    assert (3000 in got) and {v for _, v in got[3000]} >= {3001}


def test_an_id_with_two_vectors_comes_nearest_first(spark):
    rng = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(300, 6)))]
    rows += [(0, [1.0] * 6), (0, [-1.0] + [1.0] * 5), (7, [1.0] * 5 + [0.9])]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).where("query_id = 0").orderBy("rank").collect()
    scores = [r["score"] for r in found]
    assert scores == sorted(scores, reverse=True) and len({r["vec_id"] for r in found}) == 5 and found[0]["vec_id"] == 7


def test_other_versions_and_long_lengths(spark, tmp_path):
    def record(version, length, body):
        return f"WARC/{version}\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{body}>\r\nContent-Length: {length}\r\n\r\n{body}\r\n\r\n"

    text = record("1.0", "0000000003", "abc") + record("1.1", "4", "WARC") + record("1.0", "5", "fghij")
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "one.warc").write_bytes(text.encode())
    got = warc.read_archives(spark, str(tmp_path / "w"), payload=True).orderBy("at").collect()
    assert [bytes(r["payload"]).decode() for r in got] == ["abc", "WARC", "fghij"]


def test_every_place_of_a_license(spark):
    notice = max(licenses.TEMPLATES.values(), key=len)
    name = next(k for k, v in licenses.TEMPLATES.items() if v == notice)
    filler = " ".join(f"w{i % 97}x{i % 89}" for i in range(1200))
    frame = spark.createDataFrame([(1, f"\n{filler}\n".join([notice] * 5)), (2, filler)], "doc_id long, text string")
    found = licenses.scan_licenses(frame).where(F.col("license") == name)
    assert found.count() == 5
    best = licenses.best_of_each(found).collect()
    assert len(best) == 1 and best[0]["first_word"] == 0 and best[0]["containment"] == 1.0


def test_copies_without_capitals(spark):
    item = "Yesterday Natalia sold clips to 48 of her friends in April, and then she sold half as many clips in May. How many clips did Natalia sell?"
    texts = [item, item.lower(), f"words before {item.lower()} and after", item.replace("48", "52").lower(), item.upper(), "no item here at all"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"] for r in decontaminate.leaks(frame, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()}
    assert found == {0, 1, 2, 3, 4}


def test_registered_queries_of_the_new_operators(spark):
    for name in ("op11_sketch", "op12_trie", "op13_merkle"):
        assert QUERIES[name](spark, SMALL).count() > 0


def test_ids_come_in_slices_and_memories_are_bounded(spark, docs, monkeypatch):
    from promptloom.llm import pieces
    from promptloom.llm.queries import tokenizer_path

    whole = pieces.encode_documents(docs, tokenizer_path(), with_ids=True).orderBy("doc_id").collect()
    monkeypatch.setattr(pieces, "IDS_AT_ONCE", 500)
    assert pieces.encode_documents(docs, tokenizer_path(), with_ids=True).orderBy("doc_id").collect() == whole
    assert all(sha(r["ids"]) == r["ids_sha256"] and r["n_tokens"] == len(r["ids"].split(" ")) for r in whole)
    memory = pieces.Memory(lambda key: key * 2, 20_000)
    assert all(memory[f"word {k % 700}"] == f"word {k % 700}" * 2 for k in range(5000))
    assert 0 < memory.used <= 20_400 and len(memory) + len(memory.older) <= 240


def test_each_distinct_word_is_encoded_once(spark, monkeypatch):
    """Words are cut where nothing merges, so what follows a word makes no other word of it, and texts come in blocks."""
    import sentencepiece

    from promptloom.llm import pieces
    from promptloom.llm.queries import tokenizer_path

    encoded, compute = [], pieces.Pieces._encoded_word
    monkeypatch.setattr(pieces.Pieces, "_encoded_word", lambda self, word: encoded.append(word) or compute(self, word))
    own = pieces.Pieces(*pieces.load_vocabulary(tokenizer_path()))
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path())
    text = " ".join(f"thonering{end}" for end in (".", ",", "!", "?", "%%%", "&&&", ".\nThonering", "|"))
    text = f"{text} " * 50
    assert own.encode(text) == library.encode(text)
    assert len(encoded) == len(set(encoded)) and sum("honering" in str(word) for word in encoded) == 2

    monkeypatch.setattr(pieces, "TEXT_AT_ONCE", 40)
    texts = ["", "a b", "▁ ▁x", text, "-" * 200, "é日本\U0001f600 " * 30, "", " \n ", "a" * 500, "x" * 39 + " y", "thlyan" * 40]
    sizes = [sum(map(len, block.to_pylist())) for _, block in own.blocks(pa.array(texts))]
    assert len(sizes) > 100 and sorted(sizes)[-4] < 100  # only runs without a cut are longer
    rows = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(pieces, "load_vocabulary", lambda path: (own.vocabulary, own.reachable))
    for end_id in (2, None):
        for r in pieces.encode_documents(rows, tokenizer_path(), end_id=end_id, with_ids=True).collect():
            ids = library.encode(texts[r["doc_id"]]) + [2] * (end_id is not None)
            assert r["ids"] == " ".join(map(str, ids)) and r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(r["ids"])
            assert r["decoded_sha256"] == sha(library.decode(ids))
            parts = [p for k, p, _ in pieces._encoded(own, pa.array(texts)) if k == r["doc_id"]]
            assert b"".join(parts).split() == [str(i).encode() for i in library.encode(texts[r["doc_id"]])]


def test_short_words_merge_as_defined():
    from promptloom.llm import pieces
    from promptloom.llm.queries import tokenizer_path

    own = pieces.Pieces(*pieces.load_vocabulary(tokenizer_path()))
    short = sorted(p for p in own.score if 1 <= len(p) <= 5)
    for i in range(4000):
        word = short[i * 31 % len(short)] + short[i * 57 % len(short)] + short[i * 91 % len(short)]
        assert own.merge_short(word) == own.merge(word) == own.tokens(word)
    assert own.merge_short("") == [] and own.merge_short("a" * 32) == own.merge("a" * 32)


# --- memory of workers that live on --------------------------------------------------------------


def steps_in_arrow(monkeypatch, df):
    """What is passed to mapInArrow from now on: pairs of the frame and the function."""
    seen, real = [], type(df).mapInArrow
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, *rest, **more: seen.append((self, f)) or real(self, f, *rest, **more))
    return seen


def peak(run):
    """Bytes that Python and numpy held at once, beyond what they held before."""
    import tracemalloc

    tracemalloc.start()
    try:
        result = run()
        return result, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_texts_cross_to_the_classifier_once_and_come_back_in_slices(spark, monkeypatch):
    texts = [None, "", "a", *(f"Word {k} and more words. " * (k % 7) for k in range(40)), "long " * 500, "é日本 " * 3]
    rows = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").coalesce(1)
    model = quality.train([(t or "").encode() for t in texts], np.arange(len(texts)) % 2 * 1.0)
    expected = model.score([(t or "").encode() for t in texts]).tolist()
    monkeypatch.setattr(quality, "TEXT_AT_ONCE", 300)
    seen = steps_in_arrow(monkeypatch, rows)
    scored = quality.with_scores(rows, model).collect()
    assert [(r["doc_id"], r["text"], r["score"]) for r in scored] == [*zip(range(len(texts)), texts, expected)]
    (packed, run) = seen[0]
    assert packed.columns == ["row"]
    parts = [*run(packed.toArrow().to_batches())]
    assert sum(p.num_rows for p in parts) == len(texts) and max(p.num_rows for p in parts) < 20
    assert all(p.num_rows == 1 or sum(len((r["text"] or "").encode()) for r in p.column(0).to_pylist()) <= 300 for p in parts)
    # A text that is no string goes beside its row, as it did.
    numbers = spark.createDataFrame([(1, 55, "x"), (2, None, "y")], "doc_id long, text int, lang string").coalesce(1)
    assert [r["score"] for r in quality.with_scores(numbers, model).collect()] == model.score([b"55", b""]).tolist()


def test_learning_holds_few_bytes_a_feature():
    rng = random.Random(5)
    texts = [" ".join(f"{rng.randrange(1 << 40):x}" for _ in range(3_000)).encode() for _ in range(60)]
    labels = np.arange(60) % 2 * 1.0
    n = sum(len(np.unique(features)) for _, features, _ in quality.ngram_features(texts))
    rows = [(np.unique(f), np.bincount(np.unique(f, return_inverse=True)[1], v)) for _, f, v in quality.ngram_features(texts)]
    model, held = peak(lambda: quality.train(texts, labels, epochs=1))
    fixed = 40 << 20  # the sums, the weights, and the arrays of a block of texts
    assert n > 600_000 and held < fixed + 8 * n
    for features, values in rows:
        _, distinct, place = quality._packed(features, values)
        assert (distinct[place] == values).all()
    assert model.weights.any()


def test_short_texts_hash_alike_in_blocks_of_any_size(monkeypatch):
    texts = [b"", b"One two, 3!", b"four " * 90, b"", b"Five 5 " * 40, b"six" * 100]
    whole = [*quality.ngram_features(texts)]
    for size in (1, 64, 500):
        monkeypatch.setattr(quality, "TOGETHER", size)
        for (j, f, v), (k, g, w) in zip(whole, quality.ngram_features(texts), strict=True):
            assert j == k and (f == g).all() and (v == w).all()


def test_words_end_with_a_task_of_the_pipeline(spark, monkeypatch):
    import weakref

    import corpus_pipeline
    from promptloom.llm import pieces
    from promptloom.llm.queries import tokenizer_path

    rows = spark.createDataFrame([(1, "some words of a text"), (2, None)], "doc_id long, text string").coalesce(1)
    seen = steps_in_arrow(monkeypatch, rows)
    monkeypatch.setattr(pieces, "_WORKER", {})
    stage = corpus_pipeline.encoded(spark, rows, SMALL).orderBy("doc_id").collect()
    (given, run) = seen[0]
    out = run(iter(given.toArrow().to_batches()))
    assert next(out).num_rows == 2
    tables = weakref.ref(*pieces._WORKER.values())
    assert [*out] == [] and not pieces._WORKER and tables() is None
    own = pieces.encode_documents(rows, tokenizer_path(), with_ids=True)
    assert own.orderBy("doc_id").collect() == stage
    assert len([*seen[-1][1](given.toArrow().to_batches())]) == 1 and len(pieces._WORKER) == 1


def test_places_to_cut_are_looked_up_in_stretches():
    from promptloom.llm import pieces
    from promptloom.llm.queries import tokenizer_path

    own = pieces.Pieces(*pieces.load_vocabulary(tokenizer_path()))
    data = np.frombuffer(random.Random(9).randbytes(3 * pieces.CUTS_AT_ONCE + 5), np.uint8)
    cuts, held = peak(lambda: own._cuts(data))
    assert (cuts == own.cuts[data[:-1].astype(np.int64) * 256 + data[1:]]).all()
    assert held < 6 * len(data)
    for n in (0, 1, 2, pieces.CUTS_AT_ONCE, pieces.CUTS_AT_ONCE + 1, pieces.CUTS_AT_ONCE + 2):
        assert len(own._cuts(data[:n])) == max(n - 1, 0) and (own._cuts(data[:n]) == cuts[: max(n - 1, 0)]).all()
