"""Batch model calls over a column.

A model is a *loader*: a function that takes nothing and returns ``predict(prompts)``, or
``predict(prompts, params)`` when per-row parameters are given. The loader runs once per task.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import cut_at_stop, drop_prompt
from ..schemas import GENERATION
from .sample import sample_rows

Loader = Callable[[], Callable[..., Sequence]]

# Fixed value: the batch size found best for the published batch job.
BATCH_SIZE = 15
#: Rows that are taken out of an Arrow batch at a time.
ROWS_AT_ONCE = 256


def is_out_of_memory(error: BaseException) -> bool:
    """Memory errors of Python and, by name, of GPU libraries that need not be installed here."""
    return isinstance(error, MemoryError) or type(error).__name__ == "OutOfMemoryError"


def cached_loader(key: str, loader: Loader) -> Loader:
    """Load a model once per Python worker process instead of once per task.

    Workers outlive tasks, so with many more partitions than slots this saves nearly all loads.
    ``key`` names the model, for instance by its path and revision.
    """

    def load():
        import sys
        import types

        # Functions travel by value, so a plain module global would be new in every task.
        home = sys.modules.setdefault("promptloom_worker_models", types.ModuleType("promptloom_worker_models"))
        if key not in home.__dict__:
            home.__dict__[key] = loader()
        return home.__dict__[key]

    return load


def call_with_retry(predict: Callable, prompts: list, params: list | None) -> list[tuple]:
    """``(text, status, error)`` per prompt. A batch that runs out of memory is halved and retried."""
    if not prompts:
        return []
    try:
        texts = predict(prompts) if params is None else predict(prompts, params)
        return [(text, "ok", None) for text in texts]
    except Exception as error:  # noqa: BLE001 - anything but memory is raised again
        if not is_out_of_memory(error):
            raise
        if len(prompts) == 1:
            return [(None, "oom", str(error))]
    half = len(prompts) // 2
    head, tail = (None, None) if params is None else (params[:half], params[half:])
    return call_with_retry(predict, prompts[:half], head) + call_with_retry(predict, prompts[half:], tail)


def generation_udf(
    loader: Loader, batch_size: int = BATCH_SIZE, with_params: bool = False, text_only: bool = False
):
    """Iterator UDF giving ``struct<text, status, error>``, or with ``text_only`` just the text.

    Batches are sliced here, so no session setting changes. Null prompts skip the model. The UDF
    is declared non-deterministic: a sampling model must not be called twice by a rewritten plan.
    """

    def split(batch: pa.Array) -> Iterator[tuple[list, list | None]]:
        """Prompts and parameters of some rows at a time, so that a large batch isn't held as Python objects."""
        params = None
        if with_params:
            names = [f.name for f in batch.type]
            fields = dict(zip(names, batch.flatten()))
            batch = fields.pop("prompt")
            params = pa.table(list(fields.values()), names=list(fields)).to_pandas()
            for name in params:
                if isinstance(params[name].dtype, pd.DatetimeTZDtype):  # the session's time, as in a pandas UDF
                    params[name] = params[name].dt.tz_localize(None)
        step = batch_size * max(1, ROWS_AT_ONCE // batch_size)
        for at in range(0, len(batch), step):
            yield batch.slice(at, step).to_pylist(), None if params is None else params[at : at + step].to_dict("records")

    def results(batches: Iterator[pa.Array]) -> Iterator[list[tuple]]:
        predict = loader()
        for batch in batches:
            for prompts, params in split(batch):
                yield _answers(predict, prompts, params, batch_size)

    if text_only:

        def generate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            return (pa.array([r[0] for r in rows], pa.string(), from_pandas=True) for rows in results(batches))

        return F.arrow_udf(generate, "string").asNondeterministic()

    def generate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for rows in results(batches):
            columns = [pa.array(c, pa.string(), from_pandas=True) for c in zip(*rows)]
            yield pa.StructArray.from_arrays(columns, names=["text", "status", "error"])

    return F.arrow_udf(generate, GENERATION).asNondeterministic()


def generate(
    df: DataFrame,
    prompt: str | Column,
    out: str,
    loader: Loader,
    batch_size: int = BATCH_SIZE,
    params: dict[str, Column] | None = None,
    clean: Callable[[Column], Column] | None = None,
    n_partitions: int | None = None,
    without_prompt: bool = False,
    stop: Sequence[str] | Column | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Prompt expression, model, cleaning expression: adds ``out``, ``status`` and ``error``.

    ``n_partitions`` deals the rows out anew, for instance to one partition per GPU. ``profile`` asks for
    executors with given resources: the model then runs as a stage of its own over whole rows.

    ``without_prompt`` removes a prompt the model gave back in front of its answer; the answer
    ends before the first of the ``stop`` sequences (a list, or an array column); ``clean`` comes last.
    To call a model for some rows only, filter first: a UDF inside ``when`` runs on every row.
    """
    source = F.col(prompt) if isinstance(prompt, str) else prompt
    if n_partitions is not None:
        df = df.repartition(max(1, n_partitions))
    call = source
    if params is not None:
        call = F.struct(source.alias("prompt"), *[c.alias(name) for name, c in params.items()])
    if profile is None:
        model = generation_udf(loader, batch_size, with_params=params is not None)
        done = df.withColumn("_g", model(call))
    else:
        done = _with_profile(df, call, loader, batch_size, params is not None, profile)
    text = F.col("_g.text")
    if without_prompt:
        text = drop_prompt(text, source)
    if stop is not None:
        text = cut_at_stop(text, stop)
    return done.withColumns(
        {
            out: text if clean is None else clean(text),
            "status": F.col("_g.status"),
            "error": F.col("_g.error"),
        }
    ).drop("_g")


def _with_profile(
    df: DataFrame, call: Column, loader: Loader, batch_size: int, with_params: bool, profile: ResourceProfile
) -> DataFrame:
    """Rows with the model's answer in ``_g``, from a stage that runs under a resource profile.

    A UDF can't ask for resources, a map over batches can; rows pass through it as they are.
    """
    packed = df.select(F.struct("*").alias("row"), call.alias("call"))
    schema = T.StructType([packed.schema["row"], T.StructField("_g", GENERATION)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = loader()
        for batch in batches:
            calls = batch.column(1).to_pylist()
            prompts = [c["prompt"] for c in calls] if with_params else calls
            settings = [{k: v for k, v in c.items() if k != "prompt"} for c in calls] if with_params else None
            rows = _answers(predict, prompts, settings, batch_size)
            answers = pa.StructArray.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=["text", "status", "error"])
            yield pa.RecordBatch.from_arrays([batch.column(0), answers], names=["row", "_g"])

    return packed.mapInArrow(run, schema, profile=profile).select("row.*", "_g")


def _answers(predict: Callable, prompts: Sequence, params: list | None, batch_size: int) -> list[tuple]:
    """``(text, status, error)`` per prompt, in batches. Null prompts skip the model."""
    known = [i for i, p in enumerate(prompts) if p is not None]
    rows: list[tuple] = [(None, "null prompt", None)] * len(prompts)
    for start in range(0, len(known), batch_size):
        batch = known[start : start + batch_size]
        chosen = None if params is None else [params[i] for i in batch]
        for i, result in zip(batch, call_with_retry(predict, [prompts[i] for i in batch], chosen)):
            rows[i] = result
    return rows


def generate_candidates(
    df: DataFrame,
    prompt: str | Column,
    n_candidates: Column,
    out: str,
    loader: Loader,
    batch_size: int = BATCH_SIZE,
    params: dict[str, Column] | None = None,
) -> DataFrame:
    """Several answers per prompt as an array, ``n_candidates`` of them row by row.

    The model is called with parameters and sees the number of the candidate as ``candidate``.
    An answer that could not be generated is a null element; a null prompt or count gives an empty array.
    """
    source = F.col(prompt) if isinstance(prompt, str) else prompt
    others = {"n_candidates": n_candidates, **(params or {})}
    row = F.struct(source.alias("prompt"), *[c.alias(name) for name, c in others.items()])

    @F.pandas_udf("array<string>")
    def answers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        predict = loader()
        for frame in batches:
            texts: list[list] = [[] for _ in range(len(frame))]
            work = []
            for i, request in enumerate(frame.to_dict("records")):
                text, n = request.pop("prompt"), request.pop("n_candidates")
                if text is not None and n is not None and n == n:  # null counts arrive as NaN
                    n = int(n)
                    work += [(i, text, {**request, "candidate": j}) for j in range(n)]
            for start in range(0, len(work), batch_size):
                rows, prompts, settings = zip(*work[start : start + batch_size])
                for i, (answer, _, _) in zip(rows, call_with_retry(predict, list(prompts), list(settings))):
                    texts[i].append(answer)
            yield pd.Series(texts, index=frame.index, dtype=object)

    return df.withColumn(out, answers.asNondeterministic()(row))


def generate_timed(
    df: DataFrame, prompt: str, out: str, loader: Loader, batch_size: int = BATCH_SIZE, clock: Callable[[], float] = time.perf_counter
) -> DataFrame:
    """Adds the generation and its share of the batch's wall time in ``seconds``.

    The model sees the prompt only; the other columns pass through as they are. Null prompts skip the model
    and take no time.
    """
    packed = df.select(F.struct("*").alias("row"), F.col(prompt).alias("prompt"))
    schema = T.StructType(
        [packed.schema["row"], T.StructField("out", T.StringType()), T.StructField("seconds", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = loader()
        for batch in batches:
            prompts = batch.column(1).to_pylist()
            texts: list = [None] * len(prompts)
            seconds = [0.0] * len(prompts)
            known = [i for i, p in enumerate(prompts) if p is not None]
            for start in range(0, len(known), batch_size):
                part = known[start : start + batch_size]
                began = clock()
                results = call_with_retry(predict, [prompts[i] for i in part], None)
                took = clock() - began
                for i, result in zip(part, results):
                    texts[i], seconds[i] = result[0], took / len(part)
            columns = [batch.column(0), pa.array(texts, pa.string()), pa.array(seconds, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "out", "seconds"])

    return packed.mapInArrow(run, schema).select("row.*", F.col("out").alias(out), "seconds")


# Sizes to try, from single prompts to about twice the chosen batch size.
SWEEP_SIZES = (1, 2, 4, 8, 12, 16, 24, 32)


def batch_size_sweep(
    df: DataFrame,
    prompt: str,
    loader: Loader,
    sizes: Sequence[int] = SWEEP_SIZES,
    sample: int | None = None,
    key: str | None = None,
    clock: Callable[[], float] = time.perf_counter,
) -> DataFrame:
    """Per batch size: rows, elapsed seconds, seconds per row, success.

    All sizes run side by side: every prompt travels once and goes to every size, each task times its own batches
    and passes on one row per size, and times add up. A task stops calling the model with a size once that has failed there, and sizes
    behind the first failing one are left out. ``sample`` takes that many rows by ``key`` instead of all.
    Null prompts are left out.
    """
    ordered = sorted(set(sizes))
    if sample is not None:
        df = sample_rows(df, key or prompt, sample)
    work = df.where(F.col(prompt).isNotNull()).select(F.col(prompt).alias("prompt"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = loader()
        waiting: dict[int, list] = {size: [] for size in ordered}
        rows, seconds, succeeded = dict.fromkeys(ordered, 0), dict.fromkeys(ordered, 0.0), dict.fromkeys(ordered, True)
        failed = max(ordered, default=0) + 1  # the smallest size that has failed in this task

        def timed(size: int, prompts: list) -> None:
            nonlocal failed
            began = clock()
            success = size < failed
            if success:
                try:
                    predict(prompts)
                except Exception as error:  # noqa: BLE001
                    if not is_out_of_memory(error):
                        raise
                    success = False
                    if len(prompts) == size:
                        failed = size
            seconds[size] += clock() - began
            rows[size] += len(prompts)
            succeeded[size] &= success

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                for text in batch.column(0).slice(at, ROWS_AT_ONCE).to_pylist():
                    for size, queue in waiting.items():
                        queue.append(text)
                        if len(queue) == size:
                            timed(size, queue)
                            waiting[size] = []
        for size, queue in waiting.items():
            if queue:
                timed(size, queue)
        met = [size for size in ordered if rows[size]]
        columns = [[at[size] for size in met] for at in (rows, seconds, succeeded)]
        types = (pa.int32(), pa.int64(), pa.float64(), pa.bool_())
        names = ["batch_size", "n", "seconds", "success"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([met, *columns], types)], names=names)

    timings = work.mapInArrow(run, "batch_size int, n long, seconds double, success boolean")
    return summarise_sweep(timings)


def summarise_sweep(timings: DataFrame) -> DataFrame:
    """One row per batch size from ``batch_size, n, seconds, success`` of its batches."""
    table = timings.groupBy("batch_size").agg(
        F.sum("n").alias("n_rows"),
        F.round(F.sum("seconds"), 4).alias("elapsed_time"),
        (F.sum("seconds") / F.sum("n")).alias("unit_time"),
        F.min("success").alias("success"),
    )
    # At most one row per size, so this window is bounded by the list of sizes.
    failed_before = F.expr(
        "coalesce(max(not success) over (order by batch_size rows between unbounded preceding and 1 preceding), false)"
    )
    return table.withColumn("_skip", failed_before).where(~F.col("_skip")).drop("_skip")


def best_batch_size(sweep: DataFrame) -> DataFrame:
    """The successful size with the lowest time per row."""
    return sweep.where("success").orderBy("unit_time", "batch_size").limit(1)


def register_model(
    spark: SparkSession,
    name: str,
    loader: Loader,
    batch_size: int = BATCH_SIZE,
    with_params: bool = False,
    text_only: bool = True,
) -> None:
    """Make a model callable from SQL: ``SELECT name(prompt)``.

    With ``with_params`` the argument is ``named_struct('prompt', …, 'temperature', …)``; without
    ``text_only`` the result is a struct that also tells the status.
    """
    spark.udf.register(name, generation_udf(loader, batch_size, with_params, text_only))


def model_class(cls: type, *args) -> Loader:
    """A loader from a class with ``load()`` and ``predict(frame) -> Series``.

    Parameters of the rows become further columns of the frame.
    """

    def loader():
        model = cls(*args)
        model.load()

        def predict(prompts: list, params: list | None = None) -> list:
            frame = pd.DataFrame({"prompt": prompts})
            if params is not None:
                frame = pd.concat([frame, pd.DataFrame(params)], axis=1)
            return list(model.predict(frame))

        return predict

    return loader
