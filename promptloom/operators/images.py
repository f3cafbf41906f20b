"""Tables around generated images: descriptions, ids, file names, captions."""

from __future__ import annotations

import struct
import zlib

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from .sample import with_position


def image_prompts(
    descriptions: DataFrame, description: str = "description", keep_rest: bool = False
) -> DataFrame:
    """``id, diffusion_prompt``: the text behind the colon, with consecutive ids.

    Ids follow the hash order of the distinct descriptions, so images and metadata agree.
    """
    prompts = descriptions.select(description).distinct()
    return with_position(prompts, description, "id").select(
        "id", text.after_colon(description, keep_rest).alias("diffusion_prompt")
    )


def image_metadata(prompts: DataFrame, suffix: str = ".png") -> DataFrame:
    return prompts.select(text.file_name("id", suffix).alias("file_name"), F.col("diffusion_prompt").alias("text"))


def with_captions(images: DataFrame, captions: DataFrame) -> DataFrame:
    """Images and their captions by file name; Spark broadcasts the captions when they are small."""
    return images.join(captions, "file_name")


def one_colour(df: DataFrame, colour: str, name: str) -> DataFrame:
    """Adds a PNG of one pixel in the colour given as a 24-bit number."""

    @F.pandas_udf("binary")
    def encoded(colours: pd.Series) -> pd.Series:
        return colours.map(_png)

    return df.withColumn(name, encoded(colour))


def _png(colour: int) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", 1, 1, 8, 2, 0, 0, 0)
    row = b"\0" + int(colour).to_bytes(3, "big")
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(row)) + chunk(b"IEND", b"")
