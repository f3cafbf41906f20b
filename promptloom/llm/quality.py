"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL-proximal updates."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import share, text_key, text_or_empty

#: Size of the feature space, and of the sample of labelled rows that a model is fitted on.
FEATURE_BITS = 18
MAX_TRAINING_ROWS = 4_000
MAX_TRAINING_BYTES = 64 << 20
EPOCHS = 4
#: FTRL-proximal: learning rate, its smoothing, and the two regularisations.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
#: A text's n-gram frequencies sum to this, for each kind of n-gram.
SCALE = 8.0
#: Bytes of one text that are hashed at a time, bytes of short texts that are hashed together, and bytes of texts that
#: are taken out of an Arrow batch, and given back with their scores, at a time.
BLOCK = 1 << 20
TOGETHER = 1 << 18
TEXT_AT_ONCE = 4 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE_VALUE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_SPACE, _WORD, _DIGIT, _MARK = range(4)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[:33] = _SPACE
_KIND[[*range(65, 91), *range(97, 123), *range(128, 256)]] = _WORD
_KIND[48:58] = _DIGIT
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_VALUE = _BYTE_VALUE[_LOWER]
_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[65:91] = 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_POWER = _powers(_BASE, BLOCK + 1)
_INVERSE = _powers(pow(_BASE, -1, 1 << 64), BLOCK + 1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _tokens(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, hashes and shapes of the runs of letters, digits or marks in a block of bytes."""
    kind = _KIND[block]
    edge = np.flatnonzero(np.r_[True, kind[1:] != kind[:-1]]) if len(block) else np.zeros(0, np.int64)
    ends = np.r_[edge[1:], len(block)]
    real = kind[edge] != _SPACE
    starts, ends = edge[real], ends[real]
    sums = np.zeros(len(block) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[block] * _POWER[: len(block)], out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * _INVERSE[starts])
    capitals = np.zeros(len(block) + 1, np.int64)
    np.cumsum(_CAPITAL[block], out=capitals[1:])
    n_capitals, length = capitals[ends] - capitals[starts], ends - starts
    shape = kind[starts].astype(np.uint64)
    word = shape == _WORD
    shape[word & (n_capitals > 0)] = 4
    shape[word & (n_capitals == length) & (length > 1)] = 5
    marks = shape == _MARK
    shape[marks] = hashes[marks]  # marks stand for themselves
    return starts, hashes, shape


def ngram_features(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(number of the text, features, values)`` of each text, in order.

    Words and word pairs, their shapes in pairs and threes, and how many of a text's words and word
    pairs came before in it. Frequencies of each kind sum to ``SCALE``. Texts are hashed in blocks of whole
    texts; one over the block size is hashed in pieces cut at its bytes, and its counts are added up.
    """
    mask = np.uint64(64 - FEATURE_BITS)
    group: list[tuple[int, int]] = []
    size = 0

    def flush(group: list[tuple[int, int]]):
        joined = np.frombuffer(b"\n".join(texts[k] for k, _ in group) + b"\n", np.uint8)
        bounds = np.cumsum([n + 1 for _, n in group])
        starts, hashes, shapes = _tokens(joined)
        cut = np.searchsorted(starts, bounds)
        at = 0
        for (k, _), to in zip(group, cut):
            yield k, hashes[at:to], shapes[at:to]
            at = to

    def whole():
        nonlocal group, size
        for k, text in enumerate(texts):
            if size and size + len(text) + 1 > min(TOGETHER, BLOCK):
                yield from flush(group)
                group, size = [], 0
            if len(text) + 1 > BLOCK:
                parts = [_tokens(np.frombuffer(text[a : a + BLOCK], np.uint8)) for a in range(0, len(text), BLOCK)]
                yield k, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts])
                continue
            group.append((k, len(text)))
            size += len(text) + 1
        if group:
            yield from flush(group)

    for k, words, shapes in whole():
        if not len(words):
            yield k, np.zeros(0, np.int64), np.zeros(0, np.float64)
            continue
        a, b, c = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
        pairs = _mixed(words[:-1] * a + words[1:])
        kinds = [
            words,
            pairs,
            _mixed(shapes[:-1] * b + shapes[1:] + c),
            _mixed((shapes[:-2] * b + shapes[1:-1]) * c + shapes[2:]),
        ]
        features, values = [], []
        for grams in kinds:
            if len(grams):
                found, counts = np.unique(grams >> mask, return_counts=True)
                features.append(found.astype(np.int64))
                values.append(counts * (SCALE / len(grams)))
        again = [1 - len(np.unique(g)) / len(g) if len(g) else 0.0 for g in kinds[:2]]
        yield k, np.concatenate([*features, [0, 1]]), np.concatenate([*values, np.array(again) * SCALE])


@dataclass(frozen=True)
class Model:
    """Weights by feature, and the bias; ``None`` weights mean that there was nothing to learn from."""

    weights: np.ndarray | None
    bias: float = 0.0

    def score(self, texts: list[bytes]) -> np.ndarray:
        """The probability of label 1, a sparse dot product per text."""
        if self.weights is None:
            return np.ones(len(texts))
        z = np.empty(len(texts))
        for k, features, values in ngram_features(texts):
            z[k] = self.bias + self.weights[features] @ values
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _packed(features: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, distinct values and the place of each feature's value among them.

    A text has thousands of features but few frequencies: 5 or 6 bytes a feature instead of 16.
    """
    distinct, place = np.unique(values, return_inverse=True)
    return features.astype(np.int32), distinct, place.astype(np.min_scalar_type(len(distinct)))


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Follow-the-regularised-leader over the examples, in the order given."""
    if not len(texts):
        return Model(None)
    size = 1 << FEATURE_BITS
    rows: list = [None] * len(texts)
    for k, features, values in ngram_features(texts):
        # One entry per feature, and one for the bias.
        found, place = np.unique(features, return_inverse=True)
        rows[k] = _packed(np.r_[found, size], np.r_[np.bincount(place, values, len(found)), 1.0])
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights_of(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    for _ in range(epochs):
        for (features, distinct, place), label in zip(rows, labels):
            values = distinct[place]
            zs, ns = z[features], n[features]
            w = weights_of(zs, ns)
            p = 1 / (1 + np.exp(-np.clip(w @ values, -30, 30)))
            g = (p - label) * values
            sigma = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
            z[features] = zs + g - sigma * w
            n[features] = ns + g * g
    weights = weights_of(z, n)
    return Model(weights[:size].astype(np.float32), float(weights[size]))


def held_out(id_col: str = "doc_id", modulus: int = 4, remainder: int = 2):
    """Rows kept out of learning: the CRC-32 of the id as text leaves ``remainder``. Null ids are not held out."""
    crc = F.crc32(F.col(id_col).cast("string"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def fit(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    max_rows: int = MAX_TRAINING_ROWS, max_bytes: int = MAX_TRAINING_BYTES,
) -> Model:
    """A model from at most ``max_rows`` labelled documents that are not held out, chosen by a hash of the id.

    Texts of one id that are equal count once, and learning ends with the text that passes ``max_bytes``. An id with several labels counts with the largest. Training is one task over that bounded sample;
    the weights (1 MB) come back to the driver. Without labelled rows the model scores 1 everywhere.
    """
    known = (
        labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
        .withColumn("order", F.xxhash64("id"))
    )
    total = known.count()
    if total > max_rows:
        # A threshold of the hash leaves a little more than enough; no task sorts more than that.
        portion = min(1.0, 1.2 * max_rows / total + 0.01)
        known = known.where(F.col("order") < int(-(1 << 63) + portion * ((1 << 64) - 1))) if portion < 1 else known
    chosen = known.orderBy("order", "id").limit(max_rows)
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text"), text_key(text_col).alias("key"))
    sample = texts.join(F.broadcast(chosen), "id").select("order", "id", "key", "label", "text")
    # An id may stand for any number of rows: equal ones count once, and the bound holds for rows and bytes.
    met = sample.groupBy("order", "id", "key").agg(F.max(F.octet_length("text")).alias("bytes")).orderBy("order", "id", "key")
    met = met.limit(max_rows).withColumn(
        "upto", F.sum("bytes").over(Window.orderBy("order", "id", "key").rowsBetween(Window.unboundedPreceding, -1))
    )
    met = met.where(F.coalesce("upto", F.lit(0)) < max_bytes).select("order", "id", "key")
    sample = sample.join(F.broadcast(met), ["order", "id", "key"]).dropDuplicates(["order", "id", "key"])
    sample = sample.select("order", "id", "key", "label", "text")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, labels = [], []
        for batch in batches:
            texts += batch.column(4).to_pylist()
            labels += batch.column(3).to_pylist()
        model = train(texts, np.array(labels, dtype=np.float64))
        weights = None if model.weights is None else model.weights.tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([weights], pa.binary()), pa.array([model.bias])], names=["weights", "bias"])

    rows = sample.repartition(1).sortWithinPartitions("order", "id", "key").mapInArrow(learn, "weights binary, bias double").collect()
    if not rows or rows[0].weights is None:
        return Model(None)
    return Model(np.frombuffer(rows[0].weights, np.float32), rows[0].bias)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """``docs`` with a score column; one narrow step, whole texts. Null and empty texts get the bias's score.

    A text crosses to the worker once, in its row (a column that is no string goes beside it, cast), and rows come
    back with their scores some MB at a time.
    """
    shared = share(docs.sparkSession, model)
    packed = docs.select(F.struct("*").alias("row"))
    place = docs.columns.index(text_col) if text_col in docs.columns else None
    if place is None or docs.schema[place].dataType != T.StringType():
        packed, place = docs.select(F.struct("*").alias("row"), text_or_empty(text_col).cast("binary").alias("text")), None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            texts = batch.column(1) if place is None else rows.field(place)
            ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
            at = 0
            while at < len(texts):
                before = int(ends[at - 1]) if at else 0
                to = max(int(np.searchsorted(ends, before + TEXT_AT_ONCE, "right")), at + 1)
                some = texts.slice(at, to - at).cast(pa.large_binary()).to_pylist()
                scores = pa.array(shared.value.score([text or b"" for text in some]))
                yield pa.RecordBatch.from_arrays([rows.slice(at, to - at), scores], names=["row", "score"])
                at = to

    schema = T.StructType([packed.schema["row"], T.StructField("score", T.DoubleType())])
    return packed.mapInArrow(run, schema).select("row.*", F.col("score").alias(score_col))


def quality_scores(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7,
    id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_TRAINING_ROWS,
) -> DataFrame:
    """``id, held_out, score, predicted`` of every document. Null ids are kept; repeated rows score alike."""
    model = fit(docs, labels, label_col, id_col, text_col, max_rows)
    scored = with_scores(docs.select(F.col(id_col), F.col(text_col)), model, text_col, "_score")
    return scored.select(
        id_col,
        held_out(id_col).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", threshold: float = 0.7,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that are predicted to have label 1, with all their columns."""
    model = fit(docs, labels, label_col, id_col, text_col)
    name = "_score"
    while name in docs.columns:
        name += "_"
    return with_scores(docs, model, text_col, name).where(F.col(name) >= threshold).drop(name)
