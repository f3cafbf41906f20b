"""Token ids for training."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as t

#: Characters of texts that are encoded at a time, and rows that are taken out of an Arrow batch at a time.
TEXT_AT_ONCE, ROWS_AT_ONCE = 1 << 20, 256


def tokenize_rows(
    df: DataFrame,
    text: str | Callable[[], Column],
    max_length: int = 512,
    pad_to: int | None = None,
    pad_id: int = 0,
    only_full: bool = False,
    keep: list[str] | None = None,
    encoder: Callable[[], Callable[[list[str]], list[list[int]]]] | None = None,
) -> DataFrame:
    """``input_ids`` and ``attention_mask``; source columns go unless named in ``keep``.

    ``text`` is a column name or a function giving the formatted text as a Column. ``encoder``
    loads a tokenizer once per task; the default is a native hashing tokenizer without Python.
    ``only_full`` keeps rows whose own length reaches ``max_length`` after truncation.
    """
    source = F.col(text) if isinstance(text, str) else text()
    kept = list(keep or [])
    tokens = t.tokens(source) if encoder is None else encode_udf(encoder)(source)
    out = df.select(*kept, F.slice(tokens, 1, max_length).alias("_t"))
    if only_full:
        # Tested on the tokens, before ids are made of them.
        out = out.where(F.size("_t") == max_length)
    ids = t.token_ids(F.col("_t")) if encoder is None else F.col("_t")
    out = out.select(*kept, ids.alias("input_ids"))
    n = F.size("input_ids")
    ones = F.transform("input_ids", lambda _: F.lit(1))
    if pad_to is None:
        return out.withColumn("attention_mask", ones)
    missing = F.greatest(F.lit(0), F.lit(pad_to) - n)
    return out.withColumn(
        "attention_mask", F.concat(ones, F.array_repeat(F.lit(0), missing))
    ).withColumn("input_ids", F.concat("input_ids", F.array_repeat(F.lit(pad_id), missing)))


def text_blocks(texts: pa.Array) -> Iterator[list]:
    """An Arrow batch of texts in blocks of about ``TEXT_AT_ONCE`` characters, each a list of its own."""
    for at in range(0, len(texts), ROWS_AT_ONCE):
        rows = texts.slice(at, ROWS_AT_ONCE).to_pylist()
        block, size = [], 0
        for row in rows:
            block.append(row)
            size += len(row or "")
            if size >= TEXT_AT_ONCE:
                yield block
                block, size = [], 0
        if block:
            yield block


def encode_udf(encoder: Callable[[], Callable[[list[str]], list[list[int]]]]):
    """Arrow UDF around a tokenizer that is loaded once per task; it holds the ids of a block of texts at a time."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        tokenizer = encoder()
        for texts in batches:
            for block in text_blocks(texts):
                yield pa.array(tokenizer(block), pa.list_(pa.int32()))

    return encode
