"""Registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.readers import balanced
from . import ann, decontaminate, langid, licenses, merkle, pieces, quality, repeats, shards, simhash, sketches, trie, warc
from .tree_sql import merkle_sql, trie_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(build):
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@register(
    """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
    d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
    f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN NULL ELSE first END AS refers_to
    FROM f"""
)
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back over verified boundary chains."""
    return warc.archive_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@register()
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a hashed n-gram model learned from the rows that are not held out."""
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register()
def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded with merge-type pieces, and decoded."""
    docs = balanced(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.encode_documents(docs, tokenizer_path())


@register()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and their components of at most 3 differing bits."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


@register()
def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes, equal texts together."""
    return shards.shard_documents(table(spark, sf_dir, "documents"))


@register()
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by compression, dictionaries learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    content = langid.dictionaries(docs)
    found = langid.identify_languages(docs, content)
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "margin", "rejected")


@register()
def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of any 200-byte string that starts in two places."""
    return repeats.deduplicate_bytes(table(spark, sf_dir, "documents"))


@register()
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, as they are or with other numbers, names and units."""
    # Vectored reads hold a row group a second time, outside the heap.
    docs = spark.read.option("parquet.hadoop.vectored.io.enabled", "false").parquet(f"{sf_dir}/documents.parquet")
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "coverage", "n_changed")


@register()
def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows by cosine for every vector whose id is divisible by 50."""
    return ann.nearest(table(spark, sf_dir, "embeddings"))


@register()
def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan_licenses(balanced(table(spark, sf_dir, "documents").select("doc_id", "text")))


@register()
def op11_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and what peeling their differences says."""
    return sketches.fingerprint_documents(table(spark, sf_dir, "documents"))


@register(trie_sql())
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations with sums over its subtrees."""
    return trie.conversation_trie(table(spark, sf_dir, "conversations"))


@register(merkle_sql())
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle leaves, roots and proofs of all documents, checked after tampering."""
    return merkle.verify_documents(table(spark, sf_dir, "documents"))
