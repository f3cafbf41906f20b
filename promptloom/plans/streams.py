"""Streams: inference that resumes, and the log in event-time windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..models import standins
from ..operators.generate import generate
from ..session import run_path
from ..streaming import log_windows, resumable
from .registry import query, summary_sql, table

#: Micro-batches in which the files of a table arrive.
BATCHES = 4


def _as_files(df, path: str, order: str):
    """A table as a folder of files that arrive in order, ``BATCHES`` times as many as there are scan tasks for a batch.

    Their number grows with the table, so that no task writes more than a scan task has read.
    """
    each = max(1, -(-df.rdd.getNumPartitions() // BATCHES))
    df.repartitionByRange(BATCHES * each, order).sortWithinPartitions(order).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", each).parquet(path)


@query("N13 K10", f"SELECT doc_id, {summary_sql('text')} AS answer, 1::BIGINT AS n_answers FROM documents")
def resumed_inference(spark, sf):
    """Requests of all documents answered in micro-batches; a second run over the same files answers none again."""
    docs, path = table(spark, sf, "documents").select("doc_id", "text"), run_path(spark, "resumed")

    def answer(batch):
        return generate(batch, "text", "answer", standins.answer_generator).select("doc_id", "answer")

    stream = _as_files(docs, f"{path}/requests", "doc_id")
    for checkpoint in ("first", "second"):
        resumable.infer_new_rows(stream, f"{path}/answers", f"{path}/{checkpoint}", answer, "doc_id", slices=2).awaitTermination()
    done = resumable.answers(spark, f"{path}/answers")
    return done.groupBy("doc_id").agg(F.max("answer").alias("answer"), F.count(F.lit(1)).alias("n_answers"))


@query(
    "Z1 K10",
    """SELECT date_trunc('hour', ts) AS start, count(*) AS n_requests, count(*) FILTER (value > 50) AS n_unsafe,
        round(count(*) FILTER (value > 50) / count(*), 6) AS rate FROM events GROUP BY 1""",
)
def unsafe_rate_windows(spark, sf):
    """Events delivered twice, counted once per request in hourly windows of a stateful stream."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), (F.col("value") > 50).alias("unsafe"))
    twice, path = events.unionAll(events), run_path(spark, "windows")
    # Files of one table arrive in any order: only a delay as long as the table's time makes none of its rows late.
    span = events.agg(F.max(F.unix_timestamp("ts")) - F.min(F.unix_timestamp("ts"))).first()[0] or 0
    log = log_windows.once_each(_as_files(twice, f"{path}/log", "ts"), "event_id", "ts", f"{span + 1} seconds")
    log_windows.keep_latest(log_windows.unsafe_rates(log, "ts", "unsafe"), f"{path}/windows", f"{path}/checkpoint").awaitTermination()
    found = log_windows.latest(spark, f"{path}/windows")
    return found.select(F.col("start").cast("timestamp_ntz").alias("start"), "n_requests", "n_unsafe", F.round("rate", 6).alias("rate"))
