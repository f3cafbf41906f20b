"""Language identification by compression with one raw-content dictionary per language."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import share, text_or_empty

#: A dictionary is made of this many sampled documents of a language at most, with so many characters of each,
#: in stretches that are spread over the whole text. Languages that are learned, the most frequent ones.
SAMPLE_DOCS, SAMPLE_CHARACTERS, STRETCH = 100, 400, 80
MAX_LANGUAGES = 256
#: Texts are compressed in pieces of so many bytes, so that a piece finds the dictionary, not only itself.
PIECE = 4_096
LEVEL = 6
#: Nats that one byte of difference stands for in the score; calibrated on short texts.
NATS_PER_BYTE = 0.5
#: Relative difference between the two smallest sizes below which a guess is rejected.
MIN_MARGIN = 0.01
UNDETERMINED = "und"


def held_out(id_col: str = "doc_id", modulus: int = 5, remainder: int = 0):
    """Rows kept out of learning: the CRC-32 of the id as text leaves ``remainder``. Null ids are not held out."""
    crc = F.crc32(F.col(id_col).cast("string"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def dictionaries(
    docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text",
    per_language: int = SAMPLE_DOCS, characters: int = SAMPLE_CHARACTERS,
) -> dict[str, bytes]:
    """Raw dictionary content by language, most frequent language first.

    From a bounded sample: a threshold on a hash of the text lets about ``per_language`` distinct texts of
    each language through, of which the first by hash give ``characters`` each: stretches of 80, one from a
    random place of each fifth of the text, so openings that texts share don't fill a dictionary. At most
    ``MAX_LANGUAGES`` languages are learned (the most frequent; texts of others get one of those). Counts
    and dictionaries (40 KB each) of these are what reaches the driver.
    """
    place = F.xxhash64(F.lit(5), text_or_empty(text_col))
    rows = docs.select(
        F.col(lang_col).cast("string").alias("lang"), F.lower(text_or_empty(text_col)).alias("text"),
        place.alias("order"), held_out(id_col).alias("out"),
    ).where("lang is not null and not out and text != ''")
    frequent = rows.groupBy("lang").agg(F.approx_count_distinct("order").alias("texts"), F.count(F.lit(1)).alias("n"))
    frequent = frequent.orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()
    counts = {r["lang"]: r["texts"] for r in frequent}
    if not counts:
        return {}
    limits = [(lang, int(-(1 << 63) + min(1.0, 1.5 * per_language / n) * ((1 << 64) - 1))) for lang, n in counts.items()]
    limits = [(lang, min(limit, (1 << 63) - 1)) for lang, limit in limits]
    limit = F.create_map(*(F.lit(x) for pair in limits for x in pair))[F.col("lang")]
    n = max(1, characters // STRETCH)
    step = (F.length("text") - STRETCH) / n
    stretches = F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)),
        lambda i: F.substring(
            F.col("text"), F.floor((i + F.pmod(F.xxhash64("order", i), F.lit(1000)) / 1000) * step).cast("int") + 1, F.lit(STRETCH)
        ),
    )
    spread = F.when(F.length("text") <= characters, F.col("text")).otherwise(F.array_join(stretches, "\n"))
    sample = rows.where(F.col("order") <= limit).groupBy("lang", "order").agg(F.first(spread).alias("text"))
    found: dict[str, list] = {lang: [] for lang in counts}
    for lang, order, text in sample.collect():
        found[lang].append((order, text))
    return {r["lang"]: "\n".join(t for _, t in sorted(found[r["lang"]])[:per_language]).encode() for r in frequent}


class Identifier:
    """Compressors by language."""

    def __init__(self, content: dict[str, bytes], level: int = LEVEL):
        self.languages = list(content)
        self.compressors = []
        for data in content.values():
            # Dictionary content under 8 bytes is refused.
            prepared = zstandard.ZstdCompressionDict(data.ljust(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            prepared.precompute_compress(level=level)
            self.compressors.append(
                zstandard.ZstdCompressor(level=level, dict_data=prepared, write_content_size=False, write_checksum=False, write_dict_id=False)
            )

    def identify(self, text: str | None) -> tuple[str, float, float]:
        """Language of the smallest encoding, its share among all as a score, and the relative margin.

        The whole text counts, piece by piece. Equal sizes go to the language with more documents.
        """
        if not text or not self.languages or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0, 0.0
        data = text.lower().encode("utf-8", "replace")
        pieces = [data[at : at + PIECE] for at in range(0, len(data), PIECE)]
        sizes = np.array([sum(len(c.compress(p)) for p in pieces) for c in self.compressors], dtype=np.float64)
        best = int(sizes.argmin())
        score = 1 / np.exp(np.clip((sizes[best] - sizes) * NATS_PER_BYTE, -700, 0)).sum()
        others = np.delete(sizes, best)
        margin = (others.min() - sizes[best]) / others.min() if len(others) else 1.0
        return self.languages[best], float(score), float(margin)


def identify_languages(
    docs: DataFrame, content: dict[str, bytes], id_col: str = "doc_id", text_col: str = "text",
    min_margin: float = MIN_MARGIN,
) -> DataFrame:
    """``id, lang_pred, score, margin, rejected`` of every row; one narrow step over whole texts.

    ``rejected`` marks guesses whose margin is under ``min_margin``; a caller that wants no doubtful
    languages drops them. Null texts, texts without a letter, and all texts if nothing was learned, are
    ``und`` with score 0 and rejected. Null ids are kept, repeated rows answer alike.
    """
    shared = share(docs.sparkSession, content)
    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("margin", T.DoubleType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(shared.value)
        for batch in batches:
            rows = [identifier.identify(text.as_py()) for text in batch.column(1)]
            langs, scores, margins = zip(*rows) if rows else ((), (), ())
            narrow = [lang == UNDETERMINED or m < min_margin for lang, m in zip(langs, margins)]
            columns = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(margins, pa.float64()), pa.array(narrow, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
