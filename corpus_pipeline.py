"""A training corpus from raw documents: good quality, no near copies, no repeated passages, no benchmark, encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptloom.llm import decontaminate, pieces, quality, repeats, simhash
from promptloom.llm.queries import table, tokenizer_path
from promptloom.session import materialize

#: Workers live on from stage to stage beside a full heap: their tables of words stay small here, and end with a task.
WORD_MEMORY = 24 << 20


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learned from the labels of rows not held out, scores 0.7 or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, at most 3 differing bits."""
    return simhash.drop_near_duplicates(docs, n=3, max_distance=3)


def no_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without strings of 200 bytes that start in two places, up to whole characters; ``n_chars`` follows."""
    cut = repeats.without_repeats(docs, length=200)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, re-parameterised ones included."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, digests of ids and decoded text, and ``ids``, the encoded text with an end id.

    The ids stand in one string with spaces between, the bytes that ``ids_sha256`` is the digest of.
    """
    return pieces.encode_documents(docs, tokenizer_path(), with_ids=True, memory=WORD_MEMORY, keep=False)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("repeats", no_repeats),
    ("benchmark", no_benchmark),
    ("pieces", encoded),
]

#: The classifier's weights, fingerprints and merges have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
