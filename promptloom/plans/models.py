"""Model calls: SQL functions, parameters, failures, timing, sweeps, per-slot runs."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import prompts, responses, tokens
from ..functions.text import drop_prompt, strip
from ..models import standins
from ..operators import generate as g
from ..operators import partitions, stats
from ..sources import readers
from .registry import n_tokens_sql, query, summary_sql, table, texts


@query("UD7 UD8 S2", f"SELECT doc_id, {summary_sql('text')} AS answer FROM documents")
def sql_model_call(spark, sf):
    g.register_model(spark, "stand_in_generate", standins.answer_generator, with_params=True)
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return spark.sql(
        """SELECT doc_id, stand_in_generate(named_struct('prompt', text, 'temperature', CAST(0.1 AS DOUBLE))) AS answer
           FROM {docs}""",
        docs=docs,
    )


@query("N13 F12 F16 F17", "SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+'))::VARCHAR || ' words' AS answer FROM documents")
def generation_controls(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    out = g.generate(
        docs, "text", "answer", standins.echo_generator, clean=strip, without_prompt=True, stop=["STOP", ","]
    )
    return out.select("doc_id", "answer")


class Shouter:
    """A model class: loaded once, predicts on frames with prompt and parameters."""

    def __init__(self, mark: str):
        self.mark = mark

    def load(self) -> None:
        self.ready = True

    def predict(self, frame: pd.DataFrame) -> pd.Series:
        assert self.ready
        marks = frame["max_tokens"].map(lambda n: self.mark * int(n))
        return frame["prompt"].str.len().astype(str) + marks


@query("UD9 P13 Q7", "SELECT doc_id, length(text)::VARCHAR || CASE WHEN lang = 'en' THEN '!!' ELSE '!' END AS answer FROM documents")
def model_class_call(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text", "lang")
    limit = F.coalesce(F.when(F.col("lang") == "en", 2), F.lit(1))
    out = g.generate(docs, "text", "answer", g.model_class(Shouter, "!"), params={"max_tokens": limit})
    return out.select("doc_id", "answer")


def _small_memory():
    """A model whose memory holds one text of at most 20,000 characters."""

    def predict(texts):
        if sum(len(x) for x in texts) > 20_000:
            raise MemoryError("batch too large")
        return [str(len(x)) for x in texts]

    return predict


@query(
    "UD4",
    """SELECT doc_id, CASE WHEN length(text) <= 20000 THEN length(text)::VARCHAR END AS answer,
       CASE WHEN length(text) <= 20000 THEN 'ok' ELSE 'oom' END AS status FROM documents""",
)
def out_of_memory(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    return g.generate(docs, "text", "answer", _small_memory, batch_size=30).select("doc_id", "answer", "status")


_ECHO = f"""(SELECT {n_tokens_sql('text', None)} AS p, {n_tokens_sql("text || chr(10) || ' ' || " + summary_sql('text') + " || ' '", None)} AS o,
    {n_tokens_sql(summary_sql('text'), None)} AS c FROM documents)"""


@query(
    "A7 UD6",
    f"""SELECT 'with_prompt' AS counting, sum(o)::BIGINT AS n_tokens FROM {_ECHO}
        UNION ALL SELECT 'minus_prompt', sum(o - p)::BIGINT FROM {_ECHO}
        UNION ALL SELECT 'completion', sum(c)::BIGINT FROM {_ECHO}""",
)
def throughput(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    timed = g.generate_timed(docs, "text", "output", standins.echo_generator)
    counted = timed.select(
        tokens.n_tokens("text").alias("p"),
        tokens.n_tokens("output").alias("o"),
        tokens.n_tokens(drop_prompt("output", "text")).alias("c"),
        "seconds",
    )
    return stats.throughput(counted, F.col("p"), F.col("o"), F.col("c")).select("counting", "n_tokens")


def _small_batches():
    def predict(texts):
        if len(texts) > 7:
            raise MemoryError("batch too large")
        return texts

    return predict


@query(
    "A8",
    "SELECT s::INTEGER AS batch_size, n AS n_rows, s <= 7 AS success FROM (SELECT count(*) AS n FROM documents), "
    "(SELECT unnest([1, 3, 5, 7, 10]) AS s)",
)
def batch_sizes(spark, sf):
    sweep = g.batch_size_sweep(texts(spark, sf, "documents"), "text", _small_batches, [1, 3, 5, 7, 10, 15, 20])
    return sweep.select("batch_size", "n_rows", "success")


@query(
    "W3 A8",
    """WITH s AS (SELECT (1 + doc_id % 6)::INTEGER AS batch_size, count(*) AS n_rows, sum(n_chars / 1024) / count(*) AS unit_time,
           1 + doc_id % 6 <= 4 AS success FROM documents GROUP BY ALL)
       SELECT batch_size, n_rows, unit_time FROM s WHERE success ORDER BY unit_time, batch_size LIMIT 1""",
)
def best_batch_size(spark, sf):
    """Over given timings: a document stands for a batch, its length for the time; sizes over 4 fail."""
    size = (F.col("doc_id") % 6 + 1).cast("int")
    timings = table(spark, sf, "documents").select(
        size.alias("batch_size"), F.lit(1).cast("long").alias("n"), (F.col("n_chars") / 1024).alias("seconds"), (size <= 4).alias("success")
    )
    return g.best_batch_size(g.summarise_sweep(timings)).select("batch_size", "n_rows", "unit_time")


def _numbered():
    """A model that answers with the prompt's length and the candidate's number."""
    return lambda prompts, params: [f"{len(p)}/{q['candidate']}" for p, q in zip(prompts, params)]


@query(
    "N13 P12 P13 F15 A6",
    f"""WITH c AS (SELECT doc_id, text, CASE WHEN lang = 'en' THEN 3 ELSE 1 END AS n FROM documents)
        SELECT doc_id, array_to_string(list_transform(range(n), lambda i: length(text) || '/' || i), '|') AS answers,
            length(text) || '/0' AS first_answer, {n_tokens_sql('text', None)} + 3 * n AS total_tokens FROM c""",
)
def candidate_answers(spark, sf):
    n = F.coalesce(F.when(F.col("lang") == "en", 3), F.lit(1))
    out = g.generate_candidates(texts(spark, sf, "documents"), "text", n, "answers", _numbered, batch_size=8)
    found = responses.candidates("answers")
    lengths = F.transform("answers", lambda a: tokens.n_tokens(a, None).cast("bigint"))
    return out.select(
        "doc_id",
        F.array_join("answers", "|").alias("answers"),
        responses.first_candidate(found).alias("first_answer"),
        responses.usage(tokens.n_tokens("text", None), lengths)["total_tokens"].alias("total_tokens"),
    )


@query("UD5", "SELECT source, count(*) AS n_rows, sum(n_chars)::BIGINT AS n_chars FROM documents GROUP BY source")
def barrier_run(spark, sf):
    """Rows of a source meet in one partition; all partitions start together and add up their own rows."""
    n = partitions.slots(spark)
    docs = table(spark, sf, "documents").select("source", "n_chars")

    def run(batches):
        sums = None
        for frame in batches:
            part = frame.groupby("source")["n_chars"].agg(["size", "sum"])
            sums = part if sums is None else sums.add(part, fill_value=0)
        if sums is not None:
            yield pd.DataFrame({"source": sums.index, "n_rows": sums["size"].astype(int), "n_chars": sums["sum"].astype(int)})

    parts = partitions.run_on_partitions(docs, run, "source string, n_rows long, n_chars long", n)
    return parts.groupBy("source").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_chars").alias("n_chars"))


@query(
    "S10 UD5",
    "SELECT lang, count(*) AS n_rows, 'OK' AS res FROM documents GROUP BY lang",
)
def slot_check(spark, sf):
    """The table's counts beside the answer that every task slot gave."""
    answers = partitions.run_on_all_slots(spark, lambda: "OK").groupBy("res").agg(F.count(F.lit(1)).alias("n_slots"))
    counts = table(spark, sf, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))
    every = answers.where(F.col("n_slots") == partitions.slots(spark)).select("res", F.lit(1).alias("_k"))
    return counts.withColumn("_k", F.lit(1)).join(every, "_k").drop("_k")


@query(
    "S3 V2",
    """SELECT doc_id, name FROM documents JOIN (VALUES ('en', 'English'), ('de', 'German'), ('fr', 'French')) AS n(lang, name)
       USING (lang)""",
)
def language_names(spark, sf):
    """A fixed list of rows as a table, joined to the documents."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("name", T.StringType())])
    names = readers.from_rows(spark, [("en", "English"), ("de", "German"), ("fr", "French")], schema)
    return table(spark, sf, "documents").join(names, "lang").select("doc_id", "name")


@query(
    "N13 R15",
    f"""WITH p AS (SELECT doc_id, '<s>[INST] <<SYS>>Extract entities from the text below.<</SYS>> ' || text || ' [/INST] ' AS prompt FROM documents)
        SELECT doc_id, {n_tokens_sql(summary_sql('prompt'))}::INTEGER AS n_answer FROM p""",
)
def entity_answers(spark, sf):
    docs = texts(spark, sf, "documents").select("doc_id", "text")
    out = g.generate(docs, prompts.entity_extraction("text"), "answer", standins.answer_generator, batch_size=20)
    return out.select("doc_id", tokens.n_tokens("answer").alias("n_answer"))
