"""SentencePiece BPE: exact encoding by backtracking, and decoding."""

from __future__ import annotations

import gc
import hashlib
import heapq
import math
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter
from sys import getsizeof

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import share, text_or_empty

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, BYTE = range(4)
#: Bytes that a worker remembers in each of its tables (words, decoded words, pairs of tokens); older entries make
#: room. Fewer bytes cost time: words are encoded anew.
MEMORY = 96 << 20
#: Bytes of texts that are encoded at once: of these each distinct word is looked up once.
TEXT_AT_ONCE = 4 << 20
#: Bytes of a block in which the places to cut are looked up at once: 8 bytes are held for each.
CUTS_AT_ONCE = 1 << 18
#: Characters of a word that is merged pair by pair; in longer ones longest matches are tried.
SHORT = 32
#: Bytes of ids in one batch of results.
IDS_AT_ONCE = 4 << 20


class Memory(dict):
    """A dictionary that computes missing values and keeps the last ones, of up to two times ``size`` bytes."""

    def __init__(self, compute, size: int):
        super().__init__()
        self.compute, self.size, self.older, self.used = compute, size, {}, 0

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if self.used >= self.size:
            self.older, self.used = dict(self), 0
            self.clear()
        self[key] = value
        self.used += 100 + getsizeof(key) + getsizeof(value)
        return value


class Pieces:
    """A vocabulary of merge-type pieces: ``(piece, score, kind)`` by id, as the model file lists them."""

    def __init__(self, vocabulary: list[tuple[str, float, int]], reachable: frozenset[int] | None = None, memory: int = MEMORY):
        self.vocabulary = vocabulary
        self.score = {p: s for p, s, kind in vocabulary if kind == NORMAL}
        self.id_of = {p: i for i, (p, _, kind) in enumerate(vocabulary) if kind == NORMAL}
        self.known = frozenset(c for p in self.score for c in p)
        self.byte_id = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(vocabulary) if kind == BYTE}
        self.unknown_id = next((i for i, v in enumerate(vocabulary) if v[2] == UNKNOWN), 0)
        shown = {NORMAL: lambda p: p.replace(SPACE, " ").encode(), BYTE: lambda p: bytes([int(p[3:5], 16)]),
                 CONTROL: lambda p: b"", UNKNOWN: lambda p: " ⁇ ".encode()}
        self.bytes_of = [shown[kind](p) for p, _, kind in vocabulary]
        self.decimals = {p: b" %d" % i for p, i in self.id_of.items()}
        self.rank = {p: -s for p, s in self.score.items()}
        # Whatever merging makes is a piece: between two bytes that no piece has side by side nothing merges.
        side_by_side = np.zeros((256, 256), bool)
        for p in self.score:
            b = np.frombuffer(p.replace(SPACE, " ").encode(), np.uint8)
            side_by_side[b[:-1], b[1:]] = True
        side_by_side[:, 0x80:0xC0] = True  # inside a character
        self.cuts = ~side_by_side.ravel()
        if reachable is None:
            reachable = frozenset(i for p, i in self.id_of.items() if self.merge(p) == [p])
        self.reachable = reachable
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            if i in reachable:
                self.automaton.add_word(p, p)
        # A character without a piece of its own can still end up alone.
        self.all_alone = self.known <= self.score.keys()
        for c in self.known - self.score.keys():
            self.automaton.add_word(c, c)
        if len(self.automaton):
            self.automaton.make_automaton()
        # The next shorter match where a piece matches: its longest proper prefix that is a piece.
        starts = [p for p in self.automaton]
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.automaton), None) for p in starts}
        self.pairs = Memory(self._fit, memory)
        self.words = Memory(self._encoded_word, memory)
        self.shown = Memory(self._decoded_word, memory)

    def merge(self, text: str) -> list[str]:
        """The definition: merge the adjacent pair of the best score, leftmost first, until none is left."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        score, heap = self.score, []

        def offer(i: int) -> None:
            j = after[i]
            if j < len(parts):
                s = score.get(parts[i] + parts[j])
                if s is not None:
                    heapq.heappush(heap, (-s, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or len(parts[i]) != a or len(parts[j]) != b:
                continue
            parts[i], parts[j] = parts[i] + parts[j], None
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [p for p in parts if p is not None]

    def merge_short(self, text: str) -> list[str]:
        """What ``merge`` gives, without a heap: for a short text looking at all pairs costs less."""
        parts, rank, never = [*text], self.rank.get, math.inf
        ranks = [rank(a + b, never) for a, b in zip(text, text[1:])]
        while ranks and (best := min(ranks)) < never:
            i = ranks.index(best)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
        return parts

    def _fit(self, pair: tuple[str, str]) -> bool:
        """Whether two tokens stay as they are when their text is merged anew."""
        return self.merge(pair[0] + pair[1]) == [*pair]

    def tokens(self, text: str) -> list[str]:
        """The merged pieces of a text of known characters, by backtracking over longest matches."""
        if self.id_of.get(text) in self.reachable:
            return [text]
        fits = self.pairs
        # Mostly the longest matches from left to right fit already, and nothing is to be taken back.
        out = [piece for _, piece in self.automaton.iter_long(text)]
        if all(map(fits.__getitem__, zip(out, out[1:]))):
            return out
        k = next(k for k, pair in enumerate(zip(out, out[1:])) if not fits[pair])
        piece, out = self.shorter.get(out[k + 1]), out[: k + 1]
        at, n, failed = sum(map(len, out)), len(text), 0
        while at < n:
            while piece and (failed >> (at + len(piece)) & 1 or (out and not fits[out[-1], piece])):
                piece = self.shorter.get(piece)
            if piece:
                out.append(piece)
                at += len(piece)
                piece = next(self.automaton.iter_long(text, at))[1] if at < n else None
            else:
                failed |= 1 << at
                piece = self.shorter.get(out[-1])
                at -= len(out.pop())
        return out

    def _ids(self, word: str) -> bytes:
        if self.all_alone and self.known.issuperset(word):
            parts = self.merge_short(word) if len(word) <= SHORT else self.tokens(word)
            return b"".join(map(self.decimals.__getitem__, parts))
        out: list[bytes] = []
        at = 0
        while at < len(word):
            to = at
            while to < len(word) and word[to] in self.known:
                to += 1
            for piece in self.tokens(word[at:to]) if to > at else ():
                out.append(self._lone(piece) if piece not in self.id_of else self.decimals[piece])
            if to < len(word):
                out.append(self._lone(word[to]))
                to += 1
            at = to
        return b"".join(out)

    def _lone(self, character: str) -> bytes:
        """A character outside the vocabulary: its bytes."""
        if not self.byte_id:
            return b" %d" % self.unknown_id
        return b"".join(b" %d" % self.byte_id[b] for b in character.encode("utf-8", "replace"))

    def _encoded_word(self, word: bytes) -> bytes:
        return self._ids(word.decode().replace(" ", SPACE))

    def _decoded_word(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, map(int, ids.split()))).decode("utf-8", "replace").encode()

    def blocks(self, texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
        """``(place of the first text, texts)``: texts as they are encoded, of up to ``TEXT_AT_ONCE`` bytes in all.

        A longer text comes alone and in parts, cut where nothing merges.
        """
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        first = 0
        while first < len(texts):
            before = int(ends[first - 1]) if first else 0
            last = max(int(np.searchsorted(ends, before + TEXT_AT_ONCE, "right")), first + 1)
            block = texts.slice(first, last - first).cast(pa.binary())
            spaced = pc.binary_join_element_wise(b" ", pc.replace_substring(block, SPACE, " "), b"")
            block = pc.if_else(pc.equal(pc.binary_length(block), 0), b"", spaced)
            if ends[last - 1] - before <= TEXT_AT_ONCE:
                yield first, block
            else:
                text, at = block[0].as_buffer(), 0
                while at < text.size:
                    to = self._cut(np.frombuffer(text, np.uint8), at + TEXT_AT_ONCE)
                    yield first, pa.array([text[at:to].to_pybytes()], pa.binary())
                    at = to
            first = last

    def _cut(self, text: np.ndarray, place: int) -> int:
        """The first place from ``place`` on where a text can be cut, or its end."""
        while place < len(text):
            near = np.flatnonzero(self._cuts(text[place - 1 : place + TEXT_AT_ONCE]))
            if len(near):
                return place + int(near[0])
            place += TEXT_AT_ONCE
        return len(text)

    def _cuts(self, text: np.ndarray) -> np.ndarray:
        """For all bytes but the first, whether the text can be cut before them."""
        found = np.empty(max(len(text) - 1, 0), bool)
        for at in range(0, len(found), CUTS_AT_ONCE):
            some = text[at : at + CUTS_AT_ONCE + 1]
            found[at : at + CUTS_AT_ONCE] = self.cuts[some[:-1].astype(np.uint16) << 8 | some[1:]]
        return found

    def encode_block(self, texts: pa.Array) -> Iterator[tuple[bytes, bytes]]:
        """For each text of a block its ids, as decimals with a space before each, and the bytes they decode to.

        Texts are cut into words wherever nothing merges, and each distinct word is looked up once.
        """
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
        ends = ends - ends[0]
        begins = np.zeros(len(data) + 1, bool)
        begins[1:-1] = self._cuts(data)
        begins[ends] = True
        begins = np.flatnonzero(begins).astype(np.int32)
        buffers = [None, pa.py_buffer(begins), pa.py_buffer(data)]
        words = pa.Array.from_buffers(pa.binary(), len(begins) - 1, buffers).dictionary_encode()
        ids = [*map(self.words.__getitem__, words.dictionary.to_pylist())]
        places = np.searchsorted(begins, ends)

        def of_texts(values: list[bytes]) -> Iterator[bytes]:
            found = pa.array(values, pa.binary()).take(words.indices)
            whole = memoryview(found.buffers()[2] or b"")
            at = np.frombuffer(found.buffers()[1], np.int32)[places].tolist()
            return (bytes(whole[a:b]) for a, b in zip(at, at[1:]))

        return zip(of_texts(ids), of_texts([*map(self.shown.__getitem__, ids)]))

    def encode(self, text: str) -> list[int]:
        parts = (ids for _, block in self.blocks(pa.array([text])) for ids, _ in self.encode_block(block))
        return [int(i) for part in parts for i in part.split()]

    def decode(self, ids: list[int]) -> str:
        """The text of ids: spaces restored, the first one dropped, bytes that are no UTF-8 replaced."""
        text = b"".join(self.bytes_of[i] for i in ids).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=4)
def load_vocabulary(path: str) -> tuple[list[tuple[str, float, int]], frozenset[int]]:
    """Pieces, scores and kinds of a merge-type model file, and which pieces merging can make."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = ((model.is_unknown, UNKNOWN), (model.is_control, CONTROL), (model.is_byte, BYTE))
    vocabulary = [
        (model.id_to_piece(i), model.get_score(i), next((k for test, k in kinds if test(i)), NORMAL))
        for i in range(model.get_piece_size())
    ]
    if any(SPACE in p.lstrip(SPACE) for p, _, kind in vocabulary if kind == NORMAL):
        raise ValueError(f"{path} has pieces across words; its words can't be encoded one by one")
    return vocabulary, Pieces(vocabulary).reachable


_WORKER: dict[str, Pieces] = {}


def _pieces_of(key: str, broadcast, memory: int) -> Pieces:
    """One set of tables and memories per worker process."""
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = Pieces(*broadcast.value, memory)
    return _WORKER[key]


def _let_go() -> None:
    """Give back what the worker process remembers: tasks of other steps take the same worker."""
    _WORKER.clear()
    gc.collect()  # tables and their memories refer to one another
    pa.default_memory_pool().release_unused()


def _encoded(pieces: Pieces, texts: pa.Array) -> Iterator[tuple[int, bytes, bytes]]:
    """``(place, ids, decoded bytes)`` of texts, in one part or, of a long text, in several."""
    for first, block in pieces.blocks(texts):
        for k, (ids, shown) in enumerate(pieces.encode_block(block), first):
            yield k, ids, shown


def encode_documents(
    docs: DataFrame, model_path: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text",
    with_ids: bool = False, memory: int = MEMORY, keep: bool = True,
) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256`` (and ``ids``, decimals with spaces between): one row per row
    of ``docs``, no shuffle.

    Encodes whole texts exactly as the sentencepiece library does, appends ``end_id``, and decodes
    the ids again. Texts are cut wherever no piece has the bytes on both sides side by side, which is exact
    since nothing merges there; of some MB of texts each distinct word is looked up once, and each worker
    remembers frequent words, in tables of up to two times ``memory`` bytes each. A worker keeps its tables for the
    tasks to come; without ``keep`` it lets go of them at the end of each task. Null text counts
    as empty and has the end id only; null ids are kept; repeated rows are encoded each.
    """
    vocabulary = load_vocabulary(model_path)
    key = f"{hashlib.sha256(repr(vocabulary[0]).encode()).hexdigest()}:{memory}"
    shared = share(docs.sparkSession, vocabulary)  # as large as the model file, whatever the input
    last = b"" if end_id is None else b" %d" % end_id

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from encode(_pieces_of(key, shared, memory), batches)
        finally:
            if not keep:
                _let_go()

    def encode(pieces: Pieces, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, ids_digests, text_digests, all_ids, held, begin = [], [], [], [], 0, 0

            def result(end: int) -> pa.RecordBatch:
                columns = [batch.column(0).slice(begin, end - begin), pa.array(counts, pa.int64())]
                columns += [pa.array(c, pa.string()) for c in (ids_digests, text_digests, *([all_ids] * with_ids))]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for k, parts in groupby(_encoded(pieces, batch.column(1)), itemgetter(0)):
                n, ids_digest, text_digest, kept, empty = 0, hashlib.sha256(), hashlib.sha256(), [], True
                for _, ids, shown in chain(parts, [(k, last, b"")]):
                    n += ids.count(b" ")
                    if empty:
                        ids, shown = ids.removeprefix(b" "), shown.removeprefix(b" ")
                        empty = not ids
                    ids_digest.update(ids)
                    text_digest.update(shown)
                    if with_ids:
                        kept.append(ids)
                counts.append(n)
                ids_digests.append(ids_digest.hexdigest())
                text_digests.append(text_digest.hexdigest())
                if with_ids:
                    all_ids.append(b"".join(kept))
                    held += len(all_ids[-1])
                    if held >= IDS_AT_ONCE:
                        yield result(k + 1)
                        counts, ids_digests, text_digests, all_ids, held, begin = [], [], [], [], 0, k + 1
            yield result(batch.num_rows)

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
        + [T.StructField("ids", T.StringType())] * with_ids
    )
    return docs.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(run, schema)
