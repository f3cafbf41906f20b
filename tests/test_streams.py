"""Inference that resumes after a lost job, and the log in event-time windows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from promptloom.plans import streams
from promptloom.streaming import log_windows, resumable


def requests_of(spark, folder, parts):
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, "id long, text string").coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema("id long, text string").option("maxFilesPerTrigger", 1).parquet(folder)


def test_a_lost_job_goes_on_where_it_was(spark, tmp_path):
    """The model dies on its way; the next run calls it only for rows that were not answered."""
    calls = spark.sparkContext.accumulator(0)
    dying = {"after": 3}
    rows = [[(i, f"t{i}") for i in range(k * 40, k * 40 + 40)] for k in range(3)]
    stream = requests_of(spark, str(tmp_path / "requests"), rows)

    def answer(batch):
        if dying["after"] == 0:
            raise RuntimeError("lost")
        dying["after"] -= 1

        @F.udf("string")
        def model(text):
            calls.add(1)
            return text.upper()

        return batch.withColumn("answer", model.asNondeterministic()("text"))

    def run():
        return resumable.infer_new_rows(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), answer, "id", slices=2)

    with pytest.raises(Exception, match="lost"):
        run().awaitTermination()
    before = resumable.answers(spark, str(tmp_path / "out")).count()
    assert 0 < before < 120 and calls.value == before
    dying["after"] = 99
    run().awaitTermination()
    done = resumable.answers(spark, str(tmp_path / "out"))
    assert calls.value == 120
    assert {(r["id"], r["answer"]) for r in done.collect()} == {(i, f"T{i}") for i in range(120)} and done.count() == 120
    run().awaitTermination()
    assert calls.value == 120


def test_keys_are_answered_once(spark, tmp_path):
    rows = [[(1, "a"), (1, "a"), (2, "b"), (None, "no key")], [(2, "b"), (3, "c")], []]
    stream = requests_of(spark, str(tmp_path / "requests"), rows)
    assert resumable.answers(spark, str(tmp_path / "out")) is None
    resumable.infer_new_rows(
        stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), lambda b: b.withColumn("answer", F.upper("text")), "id", slices=3
    ).awaitTermination()
    assert sorted((r["id"], r["answer"]) for r in resumable.answers(spark, str(tmp_path / "out")).collect()) == [(1, "A"), (2, "B"), (3, "C")]


def minute(n):
    return dt.datetime(2024, 5, 1) + dt.timedelta(minutes=n)


def log_of(spark, folder, parts):
    schema = "id long, ts timestamp, unsafe boolean"
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)


def test_windows_equal_the_batch_form(spark, tmp_path):
    parts = [[(k * 100 + i, minute(k * 60 + i), i % 4 == 0 if i % 5 else None) for i in range(60)] for k in range(4)]
    again = [parts[0] + parts[0][:20], parts[1] + parts[0][50:], parts[2], parts[3] + parts[3]]  # delivered twice
    log = log_windows.once_each(log_of(spark, str(tmp_path / "log"), again), "id", "ts")
    rates = log_windows.unsafe_rates(log, "ts", "unsafe", "30 minutes")
    log_windows.keep_latest(rates, str(tmp_path / "windows"), str(tmp_path / "checkpoint")).awaitTermination()
    table = spark.createDataFrame([r for p in parts for r in p], "id long, ts timestamp, unsafe boolean")
    want = log_windows.unsafe_rates(table, "ts", "unsafe", "30 minutes")
    columns = ["start", "end", "n_requests", "n_unsafe", "rate"]
    found = log_windows.latest(spark, str(tmp_path / "windows")).select(columns)
    assert sorted(found.collect()) == sorted(want.select(columns).collect()) and found.count() == 8


def test_late_rows_are_kept_apart(spark, tmp_path):
    parts = [[(1, minute(0), False)], [(2, minute(600), False), (3, minute(10), True)], [(4, minute(590), False), (5, minute(5), None), (6, minute(300), True)]]
    stream = log_of(spark, str(tmp_path / "log"), parts)
    for _ in range(2):  # a second run finds nothing new
        log_windows.set_late_apart(stream, "ts", str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    ids = {n: sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out" / n)).collect()) for n in ("on_time", "late")}
    assert ids == {"on_time": [1, 2, 3, 4], "late": [5, 6]}


def test_files_of_a_larger_table_are_more_not_larger(spark, tmp_path):
    """A table of many scan tasks arrives in as many micro-batches, each of several files, and whole."""
    for n, files in ((2, 4), (24, 24)):
        at = str(tmp_path / str(n))
        stream = streams._as_files(spark.range(0, 2400, 1, n), f"{at}/in", "id")
        assert len(list((tmp_path / str(n) / "in").glob("part-*"))) == files
        seen = []
        stream.writeStream.foreachBatch(lambda b, i: seen.append(b.count())).option("checkpointLocation", f"{at}/c").trigger(
            availableNow=True
        ).start().awaitTermination()
        assert len(seen) == 4 and sum(seen) == 2400
