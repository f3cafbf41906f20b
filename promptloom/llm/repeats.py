"""Exact substring deduplication: repeated byte strings found in anchored pieces of an enhanced suffix array.

A global suffix array of all bytes can't be sorted in one place. But two equal strings of 200 bytes have
equal minimisers: of the 64-byte grams in the string, the one of the smallest hash. So suffixes are kept
only at minimisers (one in about 69 bytes) and dealt out by their gram; suffixes that share 200 bytes
meet in one bucket, where the left and right contexts of the gram are sorted, the common prefixes of the
right ones form an interval tree by a stack scan, and the left ones tell how far each interval's
members extend to the left. Only contexts that differ within a bucket are ever fetched; a context that
occurs as a whole twice is settled by its 128-bit hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .common import runs, text_or_empty

GRAM = 64
#: Window starts whose minimisers are computed at a time.
BLOCK = 1 << 18
#: Anchors of one gram that are looked at together, and differing contexts of one gram that are sorted together.
RUN_LIMIT, BUCKET_LIMIT = 200_000, 20_000
#: Buckets over this size use sorted arrays for each offset in place of the interval tree.
TREE_LIMIT = 512

_RANDOM = np.random.default_rng(7919)
_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xC2B2AE3D27D4EB4F


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(_BASE, 2 * BLOCK)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), 2 * BLOCK)
_PLACE = np.uint64((1 << 20) - 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minima over all windows of ``width`` values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    if have < width:
        values = np.minimum(values[: len(values) - (width - have)], values[width - have :])
    return values


def anchors(pieces: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """``piece, place, low, high, gram, context`` of every run of windows with one minimiser.

    The minimiser lies at byte ``place`` of ``piece``; the windows are those that start ``low`` to ``high``
    bytes before it. ``gram`` and ``context`` hash the gram and all bytes of the run's windows.
    """
    data = np.frombuffer(b"".join(pieces), np.uint8)
    bounds = np.zeros(len(pieces) + 1, np.int64)
    np.cumsum([len(p) for p in pieces], out=bounds[1:])
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return (empty,) * 6
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _POWER[: len(data)], out=sums[1:])
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * _INVERSE[: len(data) - GRAM + 1])
    packed = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    best = _smallest(packed, length - GRAM + 1)
    valid = np.zeros(len(best), bool)
    for a, b in zip(bounds[:-1], bounds[1:]):
        valid[a : max(a, b - length + 1)] = True
    starts = np.flatnonzero(valid)
    if not len(starts):
        return (empty,) * 6
    places = (best[starts] & _PLACE).astype(np.int64)
    new = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
    first, last = starts[new], starts[np.r_[new[1:] - 1, len(starts) - 1]]
    place = places[new]
    high, low = place - first, place - last
    context = _mixed((sums[last + length] - sums[first]) * _INVERSE[first] + high.astype(np.uint64))
    piece = np.searchsorted(bounds, place, side="right") - 1
    return piece, place - bounds[piece], low, high, grams[place].view(np.int64), context.view(np.int64)


def _blocks(texts: list[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in blocks: their numbers, the offset of each piece, and pieces; long texts are cut with overlap."""
    numbers, offsets, pieces, size = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), BLOCK):
            piece = text[at : at + BLOCK + length - 1]
            if size and size + len(piece) > BLOCK + length:
                yield numbers, offsets, pieces
                numbers, offsets, pieces, size = [], [], [], 0
            numbers.append(k)
            offsets.append(at)
            pieces.append(piece)
            size += len(piece)
    if pieces:
        yield numbers, offsets, pieces


#: An anchor: gram, context, text key, packed place and range, and whether the context is known to repeat.
#: Rows with ``done`` are spans that need no partner: ``place`` holds start and end.
_ANCHOR = "gram long, context long, t1 long, place long, settled boolean, done boolean"


def _pack(place, low, high, t2):
    return (place << 32) | (high << 24) | (low << 16) | t2


def _span(place: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    at = place >> 32
    return at - ((place >> 24) & 255), at - ((place >> 16) & 255) + length


def _batch_of(columns: list, schema: str) -> pa.RecordBatch:
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def _group_starts(*columns: np.ndarray) -> np.ndarray:
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _emit_anchors(length: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t1, t2 = (c.to_numpy() for c in batch.columns[:2])
            keys = np.rec.fromarrays([t1, t2])
            _, first, counts = np.unique(keys, return_index=True, return_counts=True)
            t1, t2 = t1[first], t2[first].astype(np.int64)
            texts = batch.column(2).take(pa.array(first)).to_pylist()
            parts = []
            for numbers, offsets, pieces in _blocks(texts, length):
                piece, place, low, high, gram, context = anchors(pieces, length)
                text = np.array(numbers)[piece]
                place = place + np.array(offsets)[piece]
                parts.append((gram, context, t1[text], _pack(place, low, high, t2[text]), counts[text] > 1))
            if not parts:
                continue
            gram, context, key, place, settled = (np.concatenate(x) for x in zip(*parts))
            # Contexts that occur twice in this batch are settled; one of them goes on to meet others.
            order = np.lexsort((place, key, context, gram))
            gram, context, key, place, settled = (x[order] for x in (gram, context, key, place, settled))
            starts = _group_starts(gram, context)
            sizes = np.diff(np.r_[starts, len(gram)])
            again = np.logical_or.reduceat(settled, starts) | (sizes > 1)
            yield _batch_of([gram[starts], context[starts], key[starts], place[starts], again, np.zeros(len(starts), bool)], _ANCHOR)
            rest = np.repeat(again, sizes)
            rest[starts] = False  # their spans come from the shuffle
            spans = _merged(key[rest], place[rest] & 0xFFFF, *_span(place[rest], length))
            yield _batch_of(
                [_mixed(spans[0].view(np.uint64)).view(np.int64), spans[1], spans[0], (spans[2] << 32) | spans[3],
                 np.ones(len(spans[0]), bool), np.ones(len(spans[0]), bool)], _ANCHOR)

    return emit


def _merged(key: np.ndarray, t2: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of each text, overlapping and touching ones joined."""
    if not len(key):
        return key, t2, start, end
    order = np.lexsort((start, t2, key))
    key, t2, start, end = (x[order] for x in (key, t2, start, end))
    same = _group_starts(key, t2)
    text = np.zeros(len(key), np.int64)
    text[same] = 1
    text = np.cumsum(text)
    reach = np.maximum.accumulate(end + text * (1 << 40)) - text * (1 << 40)  # per text, as texts ascend
    new = np.r_[True, (text[1:] != text[:-1]) | (start[1:] > reach[:-1])]
    first = np.flatnonzero(new)
    return key[first], t2[first], start[first], np.maximum.reduceat(end, first)


#: Spans, and (with ``gram``) contexts of grams with several contexts, of which more is to be seen.
_FOUND = "gram long, t1 long, t2 int, start long, end long, place long, settled boolean"


def _settle(length: int):
    """Over anchors sorted by (gram, context, t1, place): spans of repeated contexts, and what differs."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns, crowded in runs(batches, 0, RUN_LIMIT):
            gram, context, key, place, settled, done = columns
            if done.any():
                t2, both = context[done], place[done]
                yield _found(None, key[done], t2, both >> 32, both & 0xFFFFFFFF, None, None)
                gram, context, key, place, settled = (x[~done] for x in columns[:5])
            if not len(gram):
                continue
            starts = _group_starts(gram, context)
            sizes = np.diff(np.r_[starts, len(gram)])
            again = np.logical_or.reduceat(settled, starts) | (sizes > 1)
            rows = _group_starts(gram, context, key, place)  # once per text
            rows = rows[np.repeat(again, sizes)[rows]]
            yield _found(None, key[rows], place[rows] & 0xFFFF, *_span(place[rows], length), None, None)
            by_gram = _group_starts(gram[starts])
            many = np.repeat(np.diff(np.r_[by_gram, len(starts)]) > 1, np.diff(np.r_[by_gram, len(starts)]))
            if crowded:
                many[:] = True
            some = starts[many]
            yield _found(gram[some], key[some], place[some] & 0xFFFF, None, None, place[some], again[many])

    return settle


def _found(gram, t1, t2, start, end, place, settled) -> pa.RecordBatch:
    n = len(t1)
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    columns = [gram, t1, t2, start, end, place, settled]
    arrays = [pa.nulls(n, t) if c is None else pa.array(c).cast(t) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, names=[p.split()[0] for p in _FOUND.split(", ")])


def common_prefix(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low + 1 < high:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if low >= high or a[low] != b[low] else low + 1


def lcp_intervals(lcps: list[int]) -> Iterator[tuple[int, int, int]]:
    """``(depth, left, right)`` of the interval tree over a suffix array, children before parents.

    ``lcps[k]`` is the common prefix of suffixes k and k + 1; a stack holds the open intervals.
    """
    stack: list[tuple[int, int]] = []
    for k, depth in enumerate([*lcps, -1]):
        left = k
        while stack and stack[-1][0] > depth:
            d, left = stack.pop()
            yield d, left, k
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, left))


def extend(contexts: list[tuple[bytes, int]], length: int) -> list[tuple[int, int] | None]:
    """How far each context's repeats reach: bytes before and after the anchor, or ``None``.

    ``contexts``: differing ``(bytes, place of the anchor)``. The suffixes at the anchors are sorted; each
    interval of their common-prefix tree is a set of all suffixes that share ``depth`` bytes. Inside
    it, the reversed bytes before the anchor are put in order: neighbours show where left extensions part, and
    the longest one each member shares with any other. A repeat of at least ``length`` bytes that no
    common byte extends on either side covers all its members.
    """
    n = len(contexts)
    right = [c[at:] for c, at in contexts]
    left = [c[:at][::-1] for c, at in contexts]
    out: list = [None] * n
    if n == 2:
        a, b = common_prefix(*left), common_prefix(*right)
        return [(a, b)] * 2 if a + b >= length else out
    if n > TREE_LIMIT:
        return _extend_by_offset(left, right, length)
    order = sorted(range(n), key=right.__getitem__)
    by_left = sorted(range(n), key=left.__getitem__)
    rank = [0] * n
    for k, member in enumerate(by_left):
        rank[member] = k
    lcps = [common_prefix(right[a], right[b]) for a, b in zip(order, order[1:])]
    far = [0] * n  # bytes before the anchor, of the best repeat so far
    reach = [0] * n  # bytes after it, of the deepest interval with a repeat
    for depth, lb, rb in lcp_intervals(lcps):
        members = sorted((order[k] for k in range(lb, rb + 1)), key=rank.__getitem__)
        if all(reach[m] and far[m] == len(left[m]) for m in members):
            continue
        before = 0
        for m, following in zip(members, [*members[1:], None]):
            after = common_prefix(left[m], left[following]) if following is not None else 0
            best = max(before, after)
            if best + depth >= length:
                far[m], reach[m] = max(far[m], best), max(reach[m], depth)
            before = after
    return [(f, r) if r else None for f, r in zip(far, reach)]


def _extend_by_offset(left: list[bytes], right: list[bytes], length: int) -> list[tuple[int, int] | None]:
    """The same for large buckets: for every offset of the window, classes of equal left and right parts."""
    n = len(left)
    places = []
    for strings in (left, right):
        order = sorted(range(n), key=strings.__getitem__)
        lcps = np.array([common_prefix(strings[a], strings[b]) for a, b in zip(order, order[1:])])
        places.append((np.array(order), lcps, np.array([len(s) for s in strings])))

    def classes(which: int, depth: int) -> np.ndarray:
        order, lcps, _ = places[which]
        out = np.empty(n, np.int64)
        out[order] = np.r_[0, np.cumsum(lcps < depth)]
        return out

    far, near = np.full(n, -1), np.full(n, -1)
    for i in range(length - GRAM + 1):
        fits = (places[0][2] >= i) & (places[1][2] >= length - i)
        pairs = classes(0, i) * n + classes(1, length - i)
        _, inverse, counts = np.unique(np.where(fits, pairs, -1 - np.arange(n)), return_inverse=True, return_counts=True)
        twice = fits & (counts[inverse] > 1)
        far[twice] = i
        near[twice & (near < 0)] = i
    return [None if f < 0 else (int(f), int(length - i)) for f, i in zip(far, near)]


#: ``twice``: the text stands in two documents, which only different pieces of a crowded run don't know yet.
_CONTEXT = "gram long, t1 long, place long, settled boolean, twice boolean, bytes binary"


def _fetch(length: int):
    """The bytes of contexts, from texts joined with the anchors asked for; equal texts answer once per task."""

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set = set()
        for batch in batches:
            rows = []
            for t1, t2, text, asked in zip(*(c.to_pylist() for c in batch.columns)):
                if (t1, t2) in seen:
                    continue
                if len(seen) < 100_000:
                    seen.add((t1, t2))
                once: dict = {}
                for one in asked:
                    place = one["gram"], one["place"]
                    settled, _ = once.get(place, (False, False))
                    once[place] = settled or one["settled"], place in once
                for (gram, place), known in once.items():
                    at, high, low = place >> 32, place >> 24 & 255, place >> 16 & 255
                    rows.append((gram, t1, place, *known, text[at - high : at - low + length]))
            if rows:
                yield _batch_of(list(zip(*rows)), _CONTEXT)

    return fetch


#: Spans, or (with ``w1``) single windows of a crowded bucket.
_WINDOW = "t1 long, t2 int, start long, end long, w1 long, w2 long, settled boolean"


def _compare(length: int, limit: int):
    """Over contexts sorted by gram: the spans of the repeats in each bucket."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (gram, t1, place, settled, twice, content), crowded in runs(batches, 0, limit):
            out: list[tuple] = []
            if crowded:
                for key, p, known, text in zip(t1.tolist(), place.tolist(), (settled | twice).tolist(), content):
                    start = (p >> 32) - (p >> 24 & 255)
                    for k in range(len(text) - length + 1):
                        digest = hashlib.blake2b(text[k : k + length], digest_size=16).digest()
                        w1, w2 = (int.from_bytes(d, "little", signed=True) for d in (digest[:8], digest[8:]))
                        out.append((key, p & 0xFFFF, start + k, start + k + length, w1, w2, known))
            else:
                starts = _group_starts(gram)
                for a, b in zip(starts, np.r_[starts[1:], len(gram)]):
                    distinct: dict = {}
                    for k in range(a, b):
                        distinct.setdefault((content[k], int(place[k]) >> 24 & 255), {})[(int(t1[k]), int(place[k]))] = bool(twice[k])
                    found = extend(list(distinct), length) if len(distinct) > 1 else [None]
                    for (text, at), owners, reach in zip(distinct, distinct.values(), found):
                        if len(owners) > 1 or any(owners.values()):  # one context in two places
                            reach = (at, len(text) - at)
                        if reach:
                            for key, p in owners:
                                out.append((key, p & 0xFFFF, (p >> 32) - reach[0], (p >> 32) + reach[1], None, None, True))
            for a in range(0, len(out), 50_000):
                yield _window_batch(out[a : a + 50_000])

    return compare


def _window_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
    names = [p.split()[0] for p in _WINDOW.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _keyed(docs: DataFrame, text_col: str, *columns) -> DataFrame:
    """Texts with 80 bits of their hash, by which equal texts share all results."""
    text = text_or_empty(text_col)
    t2 = F.xxhash64(F.lit(7), text).bitwiseAND(F.lit(0xFFFF)).cast("int").alias("t2")
    return docs.select(F.xxhash64(text).alias("t1"), t2, text.cast("binary").alias("text"), *columns)


def repeated_spans(docs: DataFrame, length: int = 200, text_col: str = "text", limit: int = BUCKET_LIMIT) -> DataFrame:
    """``t1, t2, start, end``: spans of bytes covered by strings of ``length`` that also start elsewhere.

    Spans may overlap; every occurrence of a repeat is listed, under the hash of its text (equal
    texts have equal spans). A frequent passage is combined in each batch of texts before the
    shuffle. A gram with more than ``limit`` differing contexts isn't sorted in one task: its single
    windows are hashed (128 bits), combined by hash, and the hashes that occur twice are joined back.
    """
    if not GRAM <= length <= GRAM + 255:
        raise ValueError(f"length must be from {GRAM} to {GRAM + 255}")
    keyed = _keyed(docs, text_col)
    found = materialize(
        keyed.where(F.length("text") >= length)
        .mapInArrow(_emit_anchors(length), _ANCHOR)
        .repartition("gram")
        .sortWithinPartitions("gram", "context", "t1", "place")
        .mapInArrow(_settle(length), _FOUND),
        "anchors",
    )
    asked = (
        found.where("gram is not null")
        .groupBy("t1", "t2")
        .agg(F.collect_list(F.struct("gram", "place", "settled")).alias("asked"))
    )
    compared = materialize(
        keyed.where(F.length("text") >= length).join(asked, ["t1", "t2"])
        .select("t1", "t2", "text", "asked")
        .mapInArrow(_fetch(length), _CONTEXT)
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_compare(length, limit), _WINDOW),
        "spans",
    )
    spans = ["t1", "t2", "start", "end"]
    single = compared.where("w1 is not null")
    place = F.struct(*spans)
    twice = (
        single.groupBy("w1", "w2").agg(F.min(place).alias("a"), F.max(place).alias("b"), F.max("settled").alias("known"))
        .where("a < b or known").select("w1", "w2")
    )
    return (
        found.where("gram is null").select(*spans)
        .union(compared.where("w1 is null").select(*spans))
        .union(single.join(twice, ["w1", "w2"]).select(*spans))
    )


def _runs_of(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["end"]) for s in spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _whole_characters(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for start, end in spans:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            out.append((start, end))
    return out


def _cut(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def remove_repeats(
    docs: DataFrame, length: int = 200, text_col: str = "text", whole_characters: bool = True,
    limit: int = BUCKET_LIMIT,
) -> DataFrame:
    """All rows, with the bytes that ``repeated_spans`` finds taken out.

    Columns: ``kept`` (binary; valid UTF-8 with ``whole_characters``, which leaves bytes of cut
    characters), ``n_bytes, n_removed, n_spans, kept_sha256``, and ``row``, a struct of the other columns of
    ``docs``. Null text counts as empty. All occurrences go, also of repeated rows and in one text.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    keyed = _keyed(docs, text_col, F.struct(F.lit(0).alias("_"), *others).alias("row"))
    spans = repeated_spans(docs, length, text_col, limit)
    by_text = spans.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    joined = keyed.join(by_text, ["t1", "t2"], "left").select("text", "spans", "row")
    schema = T.StructType(
        [joined.schema["row"], T.StructField("kept", T.BinaryType())]
        + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
        + [T.StructField("kept_sha256", T.StringType())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                gone = _runs_of(found or [])
                if whole_characters:
                    gone = _whole_characters(text, gone)
                kept = _cut(text, gone)
                rows.append((kept, len(text), len(text) - len(kept), len(gone), hashlib.sha256(kept).hexdigest()))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.binary(), *[pa.int64()] * 3, pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(2), *columns], names=schema.names)

    return joined.mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, length: int = 200, text_col: str = "text") -> DataFrame:
    """``docs`` with repeated strings taken out of the texts; columns and rows stay. Null text becomes empty."""
    cut = remove_repeats(docs, length, text_col)
    return cut.select(*(F.col("kept").cast("string").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns))


def deduplicate_bytes(docs: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text", limit: int = BUCKET_LIMIT) -> DataFrame:
    """``id, n_bytes, n_removed, n_spans, kept_sha256`` of every document, bytes judged and removed singly."""
    cut = remove_repeats(docs.select(F.col(id_col), F.col(text_col)), length, text_col, False, limit)
    return cut.select(F.col(f"row.`{id_col}`").alias(id_col), "n_bytes", "n_removed", "n_spans", "kept_sha256")
