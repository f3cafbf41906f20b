"""License scans: MinHash bands over overlapping windows retrieve templates, containment verifies them."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import share, text_or_empty
from .license_texts import TEMPLATES

#: Words of a shingle, and the share of a template's shingles that a window must hold.
SHINGLE, MIN_CONTAINMENT = 5, 0.8
#: A window that holds a template shares a band with it with at least this probability.
COLLISION = 0.9999
#: Window sizes go by powers of two from this number of shingles.
SMALLEST_CLASS = 4
#: Words hashed at a time.
BLOCK = 1 << 19

_WORD = re.compile(r"[^\W_]+")
_RANDOM = np.random.default_rng(88172645)
_FAR = np.uint64(0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(28))


class WordHashes(dict):
    """64-bit hashes of words, remembered per worker up to a number of words."""

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "replace"))
        return value


_HASHES = WordHashes()


def words_of(text: str) -> np.ndarray:
    """Hashes of the runs of letters and digits of a text, in lower case."""
    return np.fromiter(map(_HASHES.__getitem__, _WORD.findall(text.lower())), dtype=np.uint64)


def shingles(words: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """A hash for each run of ``n`` words; none if there are fewer."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = out * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - n + 1 + k]
    return _mixed(out)


@dataclass(frozen=True)
class Group:
    """Templates of one window size: block length, band values by template, and their shingles."""

    stride: int
    names: list[str]
    minima: np.ndarray  # templates x bands
    shingles: list[np.ndarray]


def bands_for(n_shingles: int, window: int, min_containment: float = MIN_CONTAINMENT, collision: float = COLLISION) -> int:
    """Bands of one row that meet with probability ``collision``.

    A window of ``window`` shingles that holds ``min_containment`` of a template's ``n_shingles`` has at least
    the similarity j = held / (window + what is missing); one band of one row agrees with probability
    j, so 1 - (1 - j) ** bands is to reach ``collision``. One row per band gives the most recall; what else
    agrees is found out by the exact check.
    """
    held = math.ceil(min_containment * n_shingles)
    j = held / (window + n_shingles - held)
    return max(1, math.ceil(math.log(1 - collision) / math.log(1 - j))) if j < 1 else 1


class Scanner:
    """Templates grouped by window size, with their MinHash bands."""

    def __init__(self, templates: dict[str, str], min_containment: float = MIN_CONTAINMENT):
        self.min_containment = min_containment
        found: dict[int, list[tuple[str, np.ndarray]]] = {}
        for name, text in templates.items():
            hashes = np.unique(shingles(words_of(text or "")))
            if len(hashes):
                n = len(shingles(words_of(text)))
                size = max(SMALLEST_CLASS, 1 << (n - 1).bit_length())
                found.setdefault(size, []).append((name, hashes))
        bands = {size: max(bands_for(len(h), size * 3 // 2, min_containment) for _, h in group) for size, group in found.items()}
        self.bands = max(bands.values(), default=0)
        rng = np.random.default_rng(20)
        self.factors = rng.integers(1, 1 << 63, self.bands, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.groups = [
            Group(
                size // 2, [name for name, _ in group],
                np.array([[self.permuted(h, k).min() for k in range(bands[size])] for _, h in group], dtype=np.uint64),
                [h for _, h in group],
            )
            for size, group in sorted(found.items())
        ]

    def permuted(self, hashes: np.ndarray, k: int) -> np.ndarray:
        x = hashes * self.factors[k]
        return x ^ (x >> np.uint64(32))

    def scan(self, texts: list[str]) -> Iterator[tuple[int, str, float, int, int]]:
        """``(text, template, containment, first word, words)`` of every place where a template is found."""
        at, group, size = 0, [], 0
        for k, text in enumerate(texts):
            group.append(shingles(words_of(text)))
            size += len(group[-1])
            if size >= BLOCK or k + 1 == len(texts):
                for number, *rest in self._scan(group):
                    yield (at + number, *rest)
                at, group, size = k + 1, [], 0

    def _scan(self, docs: list[np.ndarray]) -> Iterator[tuple[int, str, float, int, int]]:
        lengths = np.array([len(d) for d in docs])
        joined = np.concatenate(docs) if len(docs) else np.zeros(0, np.uint64)
        if not len(joined):
            return
        starts = np.r_[0, np.cumsum(lengths)[:-1]]
        layout = []
        for g in self.groups:
            n_blocks = -(-lengths // g.stride)
            owner = np.repeat(np.arange(len(docs)), n_blocks)
            number = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(n_blocks)[:-1]], n_blocks)
            edge = starts[owner] + number * g.stride
            second = np.r_[owner[1:] == owner[:-1], False]
            third = np.r_[owner[2:] == owner[:-2], [False] * min(2, len(owner))]
            layout.append((owner, edge, second, third))
        met: list[set] = [set() for _ in self.groups]
        for k in range(self.bands):
            values = self.permuted(joined, k)
            for g, (owner, edge, second, third), seen in zip(self.groups, layout, met):
                if k >= g.minima.shape[1]:
                    continue
                block = np.minimum.reduceat(values, edge)
                window = block.copy()
                window[:-1] = np.minimum(block[:-1], np.where(second[:-1], block[1:], _FAR))
                window[:-2] = np.minimum(window[:-2], np.where(third[:-2], block[2:], _FAR))
                wanted = np.sort(g.minima[:, k])
                place = np.searchsorted(wanted, window)
                hits = np.flatnonzero(wanted[np.minimum(place, len(wanted) - 1)] == window)
                for w in hits.tolist():
                    for t in np.flatnonzero(g.minima[:, k] == window[w]).tolist():
                        seen.add((w, t))
        found: dict = {}
        for g, (owner, edge, _, _), seen in zip(self.groups, layout, met):
            for w, t in seen:
                doc, first = int(owner[w]), int(edge[w])
                inside = joined[first : min(first + 3 * g.stride, starts[doc] + lengths[doc])]
                held = np.isin(inside, g.shingles[t])
                share = len(np.unique(inside[held])) / len(g.shingles[t])
                if share >= self.min_containment:
                    places = np.flatnonzero(held)
                    word = first - int(starts[doc]) + int(places[0])
                    found.setdefault((doc, g.names[t]), []).append((word, word + int(places[-1] - places[0]) + SHINGLE, share))
        for (doc, name), spans in sorted(found.items()):
            for word, end, share in _merged(spans):
                yield doc, name, share, word, end - word


def _merged(spans: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Spans of words without overlaps, each with the best share of those it is made of."""
    out: list[tuple[int, int, float]] = []
    for begin, end, share in sorted(spans):
        if out and begin < out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end), max(out[-1][2], share))
        else:
            out.append((begin, end, share))
    return out


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text",
    min_containment: float = MIN_CONTAINMENT,
) -> DataFrame:
    """``id, license, containment, first_word, n_words`` of every place of every template in every row.

    Whole texts are cut into windows of one and a half times a template's size class, each half a class
    after the last, so every place of a template lies within one window. Windows that share a band with a
    template are compared with it: the share of the template's five-word shingles that the window
    holds must reach ``min_containment``. Overlapping windows of one template are one place, so a text that holds a
    notice several times has a row for each; ``best_of_each`` keeps one per row and template. Templates travel to the tasks (a parameter of bounded size);
    texts stay in their task, nothing is shuffled.

    Null and empty texts, and texts or templates under five words, have no shingles and give no rows, as does
    an empty table. Null ids are kept; repeated rows give rows each; other columns are ignored.
    """
    scanner = share(docs.sparkSession, Scanner(templates or TEMPLATES, min_containment))
    id_type = docs.schema[id_col].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, id_type),
            T.StructField("license", T.StringType()),
            T.StructField("containment", T.DoubleType()),
            T.StructField("first_word", T.IntegerType()),
            T.StructField("n_words", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(scanner.value.scan(batch.column(1).to_pylist()))
            if rows:
                number, names, shares, first, n = zip(*rows)
                columns = [batch.column(0).take(pa.array(number)), pa.array(names), pa.array(shares), pa.array(first, pa.int32()), pa.array(n, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)


def best_of_each(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per id and license: the place with the largest share of the template, the first of equal ones."""
    place = F.struct((-F.col("containment")).alias("less"), "first_word", "n_words")
    best = found.groupBy(id_col, "license").agg(F.min(place).alias("b"))
    return best.select(id_col, "license", (-F.col("b.less")).alias("containment"), "b.first_word", "b.n_words")
