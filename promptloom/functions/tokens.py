"""Native default tokenizer. A subword tokenizer can be plugged in at ``operators.tokenize``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# A token is a run of letters and digits, or one other visible character.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
# The same tokens with the white space in front of them (and the last one with what follows it), so
# that joining pieces gives back the text.
PIECE = r"\s*(?:[\p{L}\p{N}]+|[^\p{L}\p{N}\s])(?:\s+\z)?|\s+"

MAX_TOKENS = 2048
VOCABULARY = 32000


def tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(col(c), F.lit(TOKEN), F.lit(0))


def pieces(c: Column | str) -> Column:
    return F.regexp_extract_all(col(c), F.lit(PIECE), F.lit(0))


def n_tokens(c: Column | str, cap: int | None = None) -> Column:
    """Token count, null for a null text; ``cap`` is the truncation length (None counts everything)."""
    found = tokens(c)
    return F.array_size(found if cap is None else F.slice(found, 1, cap))


def cut(c: Column | str, n: Column | int) -> Column:
    """The text up to its ``n``-th token, white space between tokens kept."""
    limit = F.lit(n) if isinstance(n, int) else n
    return F.array_join(F.slice(pieces(c), F.lit(1), limit), "")


def token_ids(token_array: Column, vocabulary: int = VOCABULARY) -> Column:
    """Stable ids by hashing each token into a vocabulary of the given size."""
    return F.transform(
        token_array,
        lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 7), 16, 10).cast("int"), F.lit(vocabulary)),
    )


def windows(array: Column, size: int, overlap: int) -> Column:
    """Slices of ``size`` elements, each sharing ``overlap`` with the one before.

    The last slice may be short; no slice lies wholly inside the overlap of its predecessor.
    """
    if not 0 <= overlap < size:
        raise ValueError(f"overlap must be at least 0 and below the size {size}, got {overlap}")
    n = F.size(array)
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), n - overlap), F.lit(size - overlap))
    return F.when(n > 0, F.transform(starts, lambda s: F.slice(array, s, F.lit(size)))).otherwise(
        F.array().cast("array<array<string>>")
    )
