"""Tokens of vocabulary files, sequences packed from them, and batches by tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import tokens
from ..models import standins
from ..operators import batches, packing, tokenize, vocabulary
from .registry import n_tokens_sql, query, summary_sql, texts


def _byte_pieces():
    import public_tokenizers

    return vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def _word_pieces():
    import public_tokenizers

    return vocabulary.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@query("N2 N1", "SELECT doc_id, md5(text) AS decoded, true AS counted FROM documents")
def vocabulary_round_trip(spark, sf):
    """Ids of a byte-level vocabulary give the text back, and there are as many as the other library counts."""
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    ids = vocabulary.with_ids(docs, "text", "ids", _byte_pieces())
    both = vocabulary.with_token_counts(ids, "text", "n", _word_pieces())
    shown = vocabulary.with_decoded(both, "ids", "shown", _byte_pieces())
    return shown.select("doc_id", F.md5("shown").alias("decoded"), (F.size("ids") == F.col("n")).alias("counted"))


@query(
    "N5 N1",
    """SELECT doc_id, text AS joined, true AS in_order, true AS within_size FROM documents WHERE length(text) > 0""",
)
def vocabulary_chunks(spark, sf):
    """Windows of 200 tokens that share 20: put together again by their offsets, they are the text."""
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    chunks = vocabulary.chunk_by_vocabulary(docs, _byte_pieces(), size=200, overlap=20)
    counted = vocabulary.with_token_counts(chunks, "chunk", "n", _byte_pieces())
    rows = F.array_sort(F.collect_list(F.struct("chunk_no", "start", "end", "chunk")))
    whole = counted.groupBy("doc_id").agg(rows.alias("r"), F.max("n").alias("n"))
    joined = F.aggregate(
        "r", F.lit(""), lambda done, c: F.concat(done, F.substring(c["chunk"], F.length(done) - c["start"] + 1, F.length(c["chunk"])))
    )
    order = F.forall(F.sequence(F.lit(0), F.size("r") - 1), lambda i: F.get(F.col("r"), i)["chunk_no"] == i)
    # A window cut out of a text may be tokenised anew a little differently at its edges.
    return whole.select("doc_id", joined.alias("joined"), order.alias("in_order"), (F.col("n") <= 210).alias("within_size"))


@query("N2 K8", f"SELECT doc_id, least({n_tokens_sql('text')}, 512)::BIGINT AS n_tokens, true AS whole FROM documents WHERE {n_tokens_sql('text')} > 0")
def packed_sequences(spark, sf):
    """Token rows packed into sequences of 512 and read back: every row whole, in one stretch of one sequence."""
    docs = texts(spark, sf, "documents")
    rows = tokenize.tokenize_rows(docs, "text", max_length=512, keep=["doc_id"])
    packed = packing.pack_sequences(rows, "doc_id", capacity=512)
    segments = packed.select(
        "sequence", "input_ids", "segment_ids", "position_ids", "attention_mask",
        F.posexplode(F.arrays_zip(F.col("keys").alias("doc_id"), F.col("lengths").alias("n"))).alias("number", "row"),
    )
    mine = F.filter(F.arrays_zip("segment_ids", "position_ids"), lambda p: p["segment_ids"] == F.col("number") + 1)
    places = F.transform(mine, lambda p: p["position_ids"])
    whole = (places == F.sequence(F.lit(0), F.col("row.n") - 1)) & (F.size("input_ids") == 512)
    return segments.select(F.col("row.doc_id").alias("doc_id"), F.col("row.n").cast("bigint").alias("n_tokens"), whole.alias("whole"))


@query(
    "N2 K8",
    f"""WITH t AS (SELECT least({n_tokens_sql('text')}, 512) AS n FROM documents WHERE {n_tokens_sql('text')} > 0)
    SELECT sum(n)::BIGINT AS tokens, count(*) AS n_rows, true AS filled FROM t""",
)
def packing_totals(spark, sf):
    """No token is lost; the sequences are at most one more than the tokens fill, by a twentieth."""
    docs = texts(spark, sf, "documents")
    packed = packing.pack_sequences(tokenize.tokenize_rows(docs, "text", max_length=512, keep=["doc_id"]), "doc_id", capacity=512)
    held = F.sum(F.aggregate("lengths", F.lit(0), lambda a, n: a + n).cast("bigint"))
    sums = packed.agg(held.alias("tokens"), F.sum(F.size("keys")).alias("n_rows"), F.count(F.lit(1)).alias("n"))
    return sums.select("tokens", "n_rows", (F.col("n") <= F.ceil(F.col("tokens") / 512) * 1.05 + 1).alias("filled"))


@query("N13", f"SELECT doc_id, {summary_sql('text')} AS answer, 'ok' AS status, true AS within_budget FROM documents")
def token_budget_inference(spark, sf):
    """Batches of similar lengths, each within 8,192 tokens with its padding (or a single row)."""
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    done = batches.generate_within_budget(docs, "text", "answer", standins.answer_generator, budget=8_192)
    fits = (F.col("batch.rows") == 1) | (F.col("batch.rows") * F.col("batch.longest") <= 8_192)
    return done.select("doc_id", "answer", "status", fits.alias("within_budget"))


@query(
    "N13 A1",
    f"SELECT sum({n_tokens_sql('text')})::BIGINT AS tokens, true AS little_padding FROM documents",
)
def padding_share(spark, sf):
    """Padding of batches by token budget, less than that of batches of 16 rows in table order."""
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    done = batches.generate_within_budget(docs, "text", "answer", standins.answer_generator, budget=8_192)
    ordered = docs.withColumn("n", tokens.n_tokens("text")).withColumn("batch_no", F.monotonically_increasing_id())
    ordered = ordered.withColumn("batch_no", F.expr("batch_no div 16"))
    naive = ordered.groupBy("batch_no").agg((F.max("n") * F.count(F.lit(1))).alias("p"), F.sum("n").alias("t"))
    naive = naive.agg((1 - F.sum("t") / F.sum("p")).alias("naive"))
    return batches.padding(done).crossJoin(F.broadcast(naive)).select("tokens", (F.col("waste") < F.col("naive")).alias("little_padding"))
