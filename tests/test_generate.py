import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from promptloom.models import standins
from promptloom.operators import generate as g
from promptloom.operators import partitions, stats

# The models of this file travel to the workers by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def upper():
    return lambda prompts: [p.upper() for p in prompts]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, f"p{i}") for i in range(20)] + [(20, None)], "id int, p string").repartition(3)


def test_generate_with_prompt_and_cleaning(rows):
    out = g.generate(rows, F.concat(F.lit("<"), "p"), "a", upper, clean=lambda c: F.concat(c, F.lit(">")))
    got = {r["id"]: (r["a"], r["status"], r["error"]) for r in out.collect()}
    assert got[3] == ("<P3>", "ok", None) and got[20] == (None, "null prompt", None)
    assert out.columns == ["id", "p", "a", "status", "error"]


def test_batches_and_one_load_per_task(spark):
    loads, sizes = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def loader():
        loads.add(1)

        def predict(prompts):
            assert len(prompts) <= 4
            sizes.add(1)
            return prompts

        return predict

    frame = spark.range(40).select(F.col("id").cast("string").alias("p")).coalesce(1)
    assert g.generate(frame, "p", "a", loader, batch_size=4).where("a = p").count() == 40
    assert loads.value == 1 and sizes.value == 10


def test_empty_partitions(spark):
    frame = spark.createDataFrame([("x",)], "p string").repartition(4)
    assert [r["a"] for r in g.generate(frame, "p", "a", upper).collect()] == ["X"]
    assert g.generate(frame.where("false"), "p", "a", upper).count() == 0


def test_memory_errors_are_halved_and_marked(spark):
    def loader():
        class OutOfMemoryError(RuntimeError):
            pass

        def predict(prompts):
            if len(prompts) > 3 or "bad" in prompts:
                raise OutOfMemoryError("gpu")
            return [p + "!" for p in prompts]

        return predict

    texts = ["a", "b", "bad", "c", "d", "e", "f", "g"]
    frame = spark.createDataFrame([(t,) for t in texts], "p string").coalesce(1)
    got = [(r["p"], r["a"], r["status"]) for r in g.generate(frame, "p", "a", loader, batch_size=8).collect()]
    assert got == [(t, None, "oom") if t == "bad" else (t, t + "!", "ok") for t in texts]


def test_other_errors_fail_the_job(spark):
    def loader():
        def predict(prompts):
            raise KeyError("broken model")

        return predict

    frame = spark.createDataFrame([("x",)], "p string")
    with pytest.raises(Exception, match="broken model"):
        g.generate(frame, "p", "a", loader).collect()


def test_failed_rows_do_not_count_as_generated(spark):
    frame = spark.createDataFrame([(1, 5, 6, 7, "ok"), (2, 1, 1, 1, "oom")], "id int, a int, b int, c int, s string")
    row = stats.text_stats(frame, "id", "a", "b", "c", status="s").first()
    assert tuple(row) == (2, 6, 7, 7)
    empty = stats.text_stats(frame.where("false"), "id", "a", "b", "c").first()
    assert tuple(empty) == (0, None, None, None)


def test_parameters_are_per_row(spark):
    def loader():
        return lambda prompts, params: [f"{p}{q['t']}" for p, q in zip(prompts, params)]

    frame = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "p string, t int").coalesce(1)
    out = g.generate(frame, "p", "o", loader, batch_size=2, params={"t": F.col("t")})
    assert [r["o"] for r in out.collect()] == ["a1", "b2", "c3"]


def test_an_arrow_batch_is_answered_in_pieces(spark):
    """Prompts become Python objects for some rows at a time, so memory doesn't grow with the rows of an Arrow batch."""
    import gc

    def loader():
        def predict(prompts, params):
            held = sum(len(x) for x in gc.get_objects() if type(x) is list and len(x) > 300 and str(x[0]).startswith("prompt "))
            return [f"{p}{q['n']}{held}" for p, q in zip(prompts, params)]

        return predict

    frame = spark.range(0, 1500, 1, 1).select("id", F.concat(F.lit("prompt "), "id").alias("p"))
    out = g.generate(frame, "p", "a", loader, batch_size=10, params={"n": F.col("id") % 3})
    assert out.where("a = p || id % 3 || '0'").count() == 1500


def test_sql_function(spark):
    g.register_model(spark, "shout", upper)
    assert spark.sql("SELECT shout('a') AS t").first()["t"] == "A"
    g.register_model(spark, "shout_status", upper, text_only=False)
    assert spark.sql("SELECT shout_status(CAST(NULL AS string)).status AS t").first()["t"] == "null prompt"

    def loader():
        return lambda prompts, params: [p * q["n"] for p, q in zip(prompts, params)]

    g.register_model(spark, "repeated", loader, with_params=True, text_only=False)
    assert spark.sql("SELECT repeated(named_struct('prompt', 'ab', 'n', 2)).text AS t").first()["t"] == "abab"
    udf = g.generation_udf(upper, text_only=True)
    frame = spark.createDataFrame([("x",), (None,)], "p string").coalesce(1)
    assert [r["t"] for r in frame.select(udf("p").alias("t")).collect()] == ["X", None]


def test_prompt_and_stop_words_are_cut(spark):
    def loader():
        return lambda prompts: [f"{p} answer\nUser: more" for p in prompts]

    frame = spark.createDataFrame([("q", ["User:"]), ("r", [])], "p string, s array<string>").coalesce(1)
    out = g.generate(frame, "p", "a", loader, without_prompt=True, stop=F.col("s"))
    assert [r["a"] for r in out.collect()] == [" answer\n", " answer\nUser: more"]


def test_generation_runs_once_when_filtered(spark):
    """A filter on the output must not make Spark call the model a second time."""
    seen = spark.sparkContext.accumulator(0)

    def loader():
        def predict(prompts):
            seen.add(len(prompts))
            return prompts

        return predict

    frame = spark.range(10).select(F.col("id").cast("string").alias("p")).coalesce(1)
    out = g.generate(frame, "p", "a", loader)
    assert out.where("status = 'ok' AND a <> '3'").count() == 9 and seen.value == 10


def test_timing_and_throughput(spark):
    frame = spark.range(10).select(F.col("id").cast("string").alias("p")).coalesce(1)
    timed = g.generate_timed(frame, "p", "o", standins.echo_generator, batch_size=3)
    assert timed.columns == ["p", "o", "seconds"] and timed.where("seconds > 0").count() == 10
    found = {r["counting"]: r for r in stats.throughput(timed, F.lit(1), F.lit(3), F.lit(2)).collect()}
    assert {c: r["n_tokens"] for c, r in found.items()} == {"with_prompt": 30, "minus_prompt": 20, "completion": 20}
    row = found["minus_prompt"]
    assert row["tokens_per_second"] == pytest.approx(20 / row["seconds"])


def test_null_prompts_skip_timed_models(spark):
    frame = spark.createDataFrame([("a",), (None,), ("b",)], "p string").coalesce(1)
    timed = g.generate_timed(frame, "p", "o", standins.answer_generator)
    assert [(r["o"] is None, r["seconds"] > 0) for r in timed.collect()] == [(False, True), (True, False), (False, True)]
    sweep = g.batch_size_sweep(frame, "p", standins.answer_generator, [1, 2])
    assert {r["batch_size"]: r["n_rows"] for r in sweep.collect()} == {1: 2, 2: 2}


def test_sweep_of_a_sample_stops_calling_a_failed_size(spark):
    calls = spark.sparkContext.accumulator(0)

    def loader():
        def predict(prompts):
            if len(prompts) > 4:
                calls.add(1)
                raise MemoryError
            return prompts

        return predict

    frame = spark.range(500).select(F.col("id").cast("string").alias("p")).coalesce(1)
    sweep = g.batch_size_sweep(frame, "p", loader, [4, 8], sample=64)
    assert {r["batch_size"]: (r["n_rows"], r["success"]) for r in sweep.collect()} == {4: (64, True), 8: (64, False)}
    assert calls.value == 1


def test_given_timings_decide_the_best_size(spark):
    rows = [(1, 1, 0.5, True), (2, 2, 0.5, True), (2, 2, 0.7, True), (4, 4, 0.2, False), (8, 8, 0.1, True)]
    timings = spark.createDataFrame(rows, "batch_size int, n long, seconds double, success boolean")
    assert [r["batch_size"] for r in g.summarise_sweep(timings).orderBy("batch_size").collect()] == [1, 2, 4]
    assert g.best_batch_size(g.summarise_sweep(timings)).first()["batch_size"] == 2


def test_sweep_stops_at_the_first_failing_size(spark):
    def loader():
        def predict(prompts):
            if len(prompts) > 4:
                raise MemoryError
            return prompts

        return predict

    frame = spark.range(30).select(F.col("id").cast("string").alias("p")).repartition(1)
    sweep = g.batch_size_sweep(frame, "p", loader, [1, 2, 4, 8, 16])
    got = {r["batch_size"]: (r["n_rows"], r["success"]) for r in sweep.collect()}
    assert got == {1: (30, True), 2: (30, True), 4: (30, True), 8: (30, False)}
    assert g.best_batch_size(sweep).first()["batch_size"] in (1, 2, 4)


def test_sweep_sends_each_prompt_once(spark):
    """Prompts are not copied for each size on their way to the model, and a task passes on a row per size."""
    frame = spark.range(0, 3000, 1, 2).select(F.col("id").cast("string").alias("p"))
    sweep = g.batch_size_sweep(frame, "p", lambda: lambda prompts: prompts, [1, 2, 7])
    assert {r["batch_size"]: (r["n_rows"], r["success"]) for r in sweep.collect()} == {s: (3000, True) for s in (1, 2, 7)}
    plan = sweep._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "Generate explode" not in plan


def test_one_call_per_slot(spark):
    assert [r["res"] for r in partitions.run_on_all_slots(spark, lambda: "OK", 3).collect()] == ["OK"] * 3
    assert partitions.one_row_per_partition(spark, 4).rdd.getNumPartitions() == 4


def test_models_can_be_kept_per_worker(spark):
    loads = spark.sparkContext.accumulator(0)

    def slow():
        loads.add(1)
        return lambda prompts: [p + "!" for p in prompts]

    loader = g.cached_loader("model@1", slow)
    frame = spark.range(0, 64, 1, 64).select(F.col("id").cast("string").alias("p"))
    assert g.generate(frame, "p", "a", loader).where("a = p || '!'").count() == 64
    assert 1 <= loads.value < 64


def test_candidates(spark):
    def loader():
        def predict(prompts, params):
            if len(prompts) > 2 or "big" in prompts:
                raise MemoryError
            return [f"{p}{q['candidate']}{q['t']}" for p, q in zip(prompts, params)]

        return predict

    frame = spark.createDataFrame([("a", 2), ("big", 1), (None, 3), ("c", 0), ("d", None)], "p string, n int").coalesce(1)
    out = g.generate_candidates(frame, "p", F.col("n"), "c", loader, batch_size=3, params={"t": F.lit("x")})
    assert [r["c"] for r in out.collect()] == [["a0x", "a1x"], [None], [], [], []]
