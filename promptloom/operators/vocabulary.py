"""Tokenizers from vocabulary files: counts, ids and chunks by the tokens of a real model.

A tokenizer is a *loader* that travels to the tasks: a function without arguments that reads the file there,
once per worker, and returns an object with ``encode(texts)``, ``starts(texts)`` and ``decode(ids)``. Vocabularies
are read, never learned.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .generate import cached_loader
from .tokenize import TEXT_AT_ONCE, encode_udf, text_blocks

#: Token ids that are decoded at a time.
IDS_AT_ONCE = 1 << 18


class _Json:
    """A tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True  # marks inside a text are text

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [e.ids for e in self.model.encode_batch(list(texts), add_special_tokens=False)]

    def starts(self, texts: Sequence[str]) -> list[list[int]]:
        return [[a for a, _ in e.offsets] for e in self.model.encode_batch(list(texts), add_special_tokens=False)]

    def decode(self, rows: Sequence[Sequence[int]]) -> list[str]:
        return self.model.decode_batch([list(r) for r in rows], skip_special_tokens=False)


class _Ranks:
    """A file of byte pieces and ranks, one a line, for the ``tiktoken`` library."""

    def __init__(self, path: str, pattern: str):
        import base64

        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.model = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return [self.model.encode_ordinary(t) for t in texts]

    def starts(self, texts: Sequence[str]) -> list[list[int]]:
        return [_char_starts(self.model.decode_tokens_bytes(ids)) for ids in self.encode(texts)]

    def decode(self, rows: Sequence[Sequence[int]]) -> list[str]:
        return [self.model.decode(list(r)) for r in rows]


class _Pieces:
    """A model file of the ``sentencepiece`` library."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def encode(self, texts: Sequence[str]) -> list[list[int]]:
        return self.model.encode(list(texts), num_threads=1)

    def starts(self, texts: Sequence[str]) -> list[list[int]]:
        return [_characters_before(t, [p.begin for p in self.model.encode(t, return_type="proto").pieces]) for t in texts]

    def decode(self, rows: Sequence[Sequence[int]]) -> list[str]:
        return self.model.decode([list(r) for r in rows])


def _characters_before(text: str, offsets: list[int]) -> list[int]:
    """Ascending offsets in bytes as offsets in characters."""
    data, out, at, characters = text.encode("utf-8", "replace"), [], 0, 0
    for offset in offsets:
        characters += sum(b & 0xC0 != 0x80 for b in data[at:offset])
        at = max(at, offset)
        out.append(characters)
    return out


def _char_starts(pieces: list[bytes]) -> list[int]:
    """Offsets in characters of byte pieces; a piece that begins inside a character starts where that does."""
    out, characters = [], 0
    for piece in pieces:
        inside = bool(piece) and piece[0] & 0xC0 == 0x80
        out.append(characters - 1 if inside else characters)
        characters += sum(b & 0xC0 != 0x80 for b in piece)
    return out


def from_file(path: str, pattern: str | None = None) -> Callable:
    """The loader of a vocabulary file, by its suffix: ``.json``, ``.tiktoken`` (with a ``pattern``) or ``.model``.

    The file must be readable under this path on every executor. A worker process reads it once.
    """
    kinds = {"json": _Json, "tiktoken": lambda p: _Ranks(p, pattern), "model": _Pieces}
    suffix = path.rsplit(".", 1)[-1]
    if suffix not in kinds or (suffix == "tiktoken" and pattern is None):
        raise ValueError(f"can't read {path}: a .json, .tiktoken (with a pattern) or .model file is needed")

    def load():
        return kinds[suffix](path)

    return cached_loader(f"vocabulary:{path}", load)


def encoder(loader: Callable) -> Callable:
    """What ``tokenize_rows(encoder=…)`` takes: a loader of ``encode(texts)``; null texts give null."""

    def load():
        model = loader()

        def encode(texts: list) -> list:
            known = [t for t in texts if t is not None]
            ids = iter(model.encode(known))
            return [None if t is None else next(ids) for t in texts]

        return encode

    return load


def _blocks(texts: Sequence[str]) -> Iterator[slice]:
    at = size = 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= TEXT_AT_ONCE:
            yield slice(at, k + 1)
            at, size = k + 1, 0
    if at < len(texts):
        yield slice(at, len(texts))


def _id_blocks(rows: pa.Array) -> Iterator[pa.Array]:
    """An Arrow batch of lists of ids in slices of about ``IDS_AT_ONCE`` ids."""
    at = size = 0
    for k, n in enumerate(pc.list_value_length(rows).to_pylist()):
        size += n or 0
        if size >= IDS_AT_ONCE:
            yield rows.slice(at, k + 1 - at)
            at, size = k + 1, 0
    if at < len(rows):
        yield rows.slice(at)


def with_token_counts(df: DataFrame, text: str, out: str, loader: Callable) -> DataFrame:
    """Adds the number of tokens, null for a null text. Whole texts count; nothing is shuffled."""

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = loader()
        for texts in batches:
            for block in text_blocks(texts):
                sizes = iter([len(ids) for ids in model.encode([t for t in block if t is not None])])
                yield pa.array([None if t is None else next(sizes) for t in block], pa.int64())

    return df.withColumn(out, count(F.col(text)))


def with_decoded(df: DataFrame, ids: str, out: str, loader: Callable) -> DataFrame:
    """Adds the text of token ids."""

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = loader()
        for rows in batches:
            for part in _id_blocks(rows):
                known, ids = part.is_valid().to_pylist(), part.flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(pc.fill_null(pc.list_value_length(part), 0).to_numpy(zero_copy_only=False))
                lists = [x.tolist() for x in np.split(ids, ends[:-1])]
                shown = iter(model.decode([x for x, k in zip(lists, known) if k]))
                yield pa.array([next(shown) if k else None for k in known], pa.string())

    return df.withColumn(out, decode(F.col(ids)))


def with_ids(df: DataFrame, text: str, out: str, loader: Callable) -> DataFrame:
    """Adds the token ids of the whole text."""
    return df.withColumn(out, encode_udf(encoder(loader))(F.col(text)))


def window_starts(n: int, size: int, overlap: int) -> range:
    """First tokens of windows; none lies wholly inside the overlap of the one before."""
    if not 0 <= overlap < size:
        raise ValueError(f"overlap must be at least 0 and below the size {size}, got {overlap}")
    return range(0, max(1, n - overlap) if n else 0, size - overlap)


def chunk_by_vocabulary(
    df: DataFrame, loader: Callable, text: str = "text", size: int = 3500, overlap: int = 400,
    name: str = "chunk", index: str = "chunk_no",
) -> DataFrame:
    """One row per window of ``size`` tokens that shares ``overlap`` tokens with the one before.

    A chunk is the stretch of the text from its first token to the window's end, cut at character offsets, so
    it is never put together from decoded ids. ``start`` and ``end`` are its places in the text; white space
    that belongs to no token goes to the chunk before it, and before the first token to the first chunk.
    A window that would end inside a character ends before it. Null and empty texts give no rows.
    """
    window_starts(1, size, overlap)
    kept = [c for c in df.columns if c != text]
    packed = df.where(F.col(text).isNotNull()).select(F.struct(F.lit(0).alias("_"), *kept).alias("row"), F.col(text).alias("text"))
    fields = [("start", T.IntegerType()), ("end", T.IntegerType()), (index, T.IntegerType()), (name, T.StringType())]
    schema = T.StructType([packed.schema["row"], *[T.StructField(n, t) for n, t in fields]])

    def cuts(text: str, starts: list[int]) -> list[tuple]:
        out = []
        for k, first in enumerate(window_starts(len(starts), size, overlap)):
            last = first + size
            begin = starts[first] if first else 0
            end = starts[last] if last < len(starts) else len(text)
            out.append((begin, end, k, text[begin:end]))
        return out or ([(0, len(text), 0, text)] if text else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loader()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for block in _blocks(texts):
                some = texts[block]
                found = [cuts(t, s) for t, s in zip(some, model.starts(some))]
                rows = [r for f in found for r in f]
                if rows:
                    number = [block.start + i for i, f in enumerate(found) for _ in f]
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(number)), *columns], names=schema.names)

    return packed.mapInArrow(run, schema).select(*[F.col(f"row.`{c}`") for c in kept], index, name, "start", "end")
