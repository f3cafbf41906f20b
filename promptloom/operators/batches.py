"""Model calls in batches of similar lengths, cut where padding would pass a budget of tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.tokens import n_tokens
from ..schemas import GENERATION
from .generate import Loader, call_with_retry

#: Fixed value: rows of a batch at most, whatever their length.
MAX_ROWS = 256


def budget_cuts(lengths: list[int], budget: int, max_rows: int = MAX_ROWS) -> list[tuple[int, int]]:
    """``(begin, end)`` of batches over descending lengths: rows times the longest stay within the budget.

    A row that alone passes the budget is a batch of its own.
    """
    out, begin = [], 0
    for k in range(len(lengths) + 1):
        if k > begin and (k == len(lengths) or (k + 1 - begin) * max(1, lengths[begin]) > budget or k - begin >= max_rows):
            out.append((begin, k))
            begin = k
    return out


def generate_within_budget(
    df: DataFrame, prompt: str, out: str, loader: Loader, budget: int = 16_384, length: Column | None = None,
    max_rows: int = MAX_ROWS,
) -> DataFrame:
    """Adds ``out``, ``status``, ``error`` and ``batch``, a struct of ``rows, longest, tokens`` of the row's batch.

    Rows of each partition are taken by descending length (tokens by default, or any integer column) and cut
    into batches whose padded size, rows times the longest, stays within ``budget``; one row over it is
    a batch of its own. Each answer stands in its row, and rows come back in the order they had in their
    partition. Nothing is shuffled. Null prompts skip the model, have status ``null prompt`` and no batch; a
    batch that runs out of memory is halved and retried.
    """
    size = F.coalesce(length if length is not None else n_tokens(prompt), F.lit(0)).cast("int")
    packed = df.select(F.struct("*").alias("row"), F.col(prompt).alias("prompt"), size.alias("size"))
    packed = packed.withColumn("place", F.monotonically_increasing_id())
    packed = packed.sortWithinPartitions(F.col("prompt").isNull(), F.desc("size"), "place")
    batch_type = T.StructType([T.StructField(n, T.LongType()) for n in ("rows", "longest", "tokens")])
    schema = T.StructType(
        [packed.schema["row"], packed.schema["place"], T.StructField("_g", GENERATION), T.StructField("batch", batch_type)]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = loader()
        for batch in batches:
            prompts, sizes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            known = sum(p is not None for p in prompts)  # nulls come last
            answers: list[tuple] = []
            shapes: list = []
            for begin, end in budget_cuts(sizes[:known], budget, max_rows):
                answers += call_with_retry(predict, prompts[begin:end], None)
                shapes += [{"rows": end - begin, "longest": sizes[begin], "tokens": sum(sizes[begin:end])}] * (end - begin)
            answers += [(None, "null prompt", None)] * (len(prompts) - known)
            shapes += [None] * (len(prompts) - known)
            columns = [pa.array(c, pa.string()) for c in zip(*answers)] if answers else [pa.array([], pa.string())] * 3
            made = pa.StructArray.from_arrays(columns, names=["text", "status", "error"])
            shape = pa.array(shapes, pa.struct([(n, pa.int64()) for n in ("rows", "longest", "tokens")]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), made, shape], names=schema.names)

    done = packed.mapInArrow(run, schema).sortWithinPartitions("place")
    return done.select("row.*", F.col("_g.text").alias(out), F.col("_g.status").alias("status"), F.col("_g.error").alias("error"), "batch")


def padding(done: DataFrame) -> DataFrame:
    """``tokens, padded, waste``: tokens of all rows, what they take with padding, and the share that is padding."""
    known = done.where("batch is not null")
    # Each of a batch's rows carries the batch once.
    sums = known.agg(F.sum(F.col("batch.tokens") / F.col("batch.rows")).alias("t"), F.sum("batch.longest").alias("p"))
    return sums.select(
        F.round("t").cast("long").alias("tokens"), F.col("p").cast("long").alias("padded"),
        F.when(F.col("p") > 0, 1 - F.col("t") / F.col("p")).otherwise(F.lit(0.0)).alias("waste"),
    )
