"""Cutting long texts before anything embeds them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tokens as t


def chunk_characters(
    df: DataFrame, text: str = "text", size: int = 1500, name: str = "chunk", index: str = "chunk_no"
) -> DataFrame:
    """Pieces of ``size`` characters without overlap, one row each; an empty text gives none.

    One regex pass over the text: ``substring`` per piece would rescan it from the start.
    """
    kept = [c for c in df.columns if c != text]
    chunks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    return df.select(*kept, F.posexplode(chunks).alias(index, name))


def chunk_tokens(
    df: DataFrame,
    text: str = "text",
    size: int = 3500,
    overlap: int = 400,
    name: str = "chunk",
    index: str = "chunk_no",
) -> DataFrame:
    """Pieces of ``size`` tokens sharing ``overlap`` tokens; the text between tokens is kept as it is."""
    kept = [c for c in df.columns if c != text]
    split = df.select(*kept, t.pieces(text).alias("_pieces"))
    chunks = F.transform(t.windows(F.col("_pieces"), size, overlap), lambda w: F.array_join(w, ""))
    return split.select(*kept, F.posexplode(chunks).alias(index, name))


def training_pairs(df: DataFrame, query: str, positives: str, prefix) -> DataFrame:
    """One ``(query, positive)`` row per element of the positives, with the query prefixed."""
    return df.select(prefix(query).alias("query"), F.explode(positives).alias("positive"))
