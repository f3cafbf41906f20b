"""Response records, usage, prompt removal, stamps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import responses, text, tokens
from ..sources import readers
from .registry import PIECE_SQL, n_tokens_sql, query, table, texts


@query(
    "P12",
    """SELECT doc_id, CASE WHEN lang = 'es' THEN NULL ELSE text END AS answer FROM documents""",
)
def first_candidate(spark, sf):
    both = responses.candidates(F.array("text", "source"))
    given = F.when(F.col("lang") != "es", both).otherwise(F.slice(both, 1, 0))
    docs = table(spark, sf, "documents").select("doc_id", given.alias("candidates"))
    return docs.select("doc_id", responses.first_candidate("candidates").alias("answer"))


@query(
    "P14 P15",
    """SELECT doc_id, '{"response":' || CASE WHEN lang = 'es' THEN 'null' ELSE to_json(source)::VARCHAR END || '}' AS json
       FROM documents""",
)
def json_response(spark, sf):
    docs = table(spark, sf, "documents").select(F.when(F.col("lang") != "es", F.col("source")), "doc_id")
    return docs.select("doc_id", responses.json_response(readers.first_column(docs)).alias("json"))


# Two answers of each document, cut at the request's limit, with the token counts of what is left.
_LIMIT_SQL = "CASE WHEN lang = 'en' THEN 512 ELSE 64 END"
_ANSWERS = f"""(SELECT *, array_to_string(list_slice(regexp_extract_all(text || ' ' || source, '{PIECE_SQL}'), 1, m), '') AS first_text,
    least({n_tokens_sql("text || ' ' || source")}, m) AS a, least({n_tokens_sql('source')}, m) AS b, {n_tokens_sql('text')} AS p
    FROM (SELECT *, {_LIMIT_SQL} AS m FROM documents))"""


def answered(spark, sf):
    """``doc_id, t, n, p, m``: answers, their token counts, the prompt's, and the most that was asked for."""
    limit = F.when(F.col("lang") == "en", 512).otherwise(64)
    rows = texts(spark, sf, "documents").select("doc_id", "text", F.concat_ws(" ", "text", "source").alias("x"), "source", limit.alias("m"))
    cut = rows.select("doc_id", "text", "m", F.array(tokens.cut("x", F.col("m")), tokens.cut("source", F.col("m"))).alias("t"))
    lengths = F.transform("t", lambda x: tokens.n_tokens(x).cast("bigint"))
    return cut.select("doc_id", "t", lengths.alias("n"), tokens.n_tokens("text").alias("p"), "m")


@query(
    "A6 F15",
    f"""SELECT doc_id, p AS prompt_tokens, greatest(a, b) AS longest_completion_tokens, a + b AS completion_tokens,
        p + a + b AS total_tokens, CASE WHEN a >= m THEN 'length' ELSE 'stop' END AS finish_reason FROM {_ANSWERS}""",
)
def token_usage(spark, sf):
    rows = answered(spark, sf)
    first = F.get(responses.candidates("t", "n", F.col("m")), F.lit(0))
    return rows.select(
        "doc_id", responses.usage("p", "n").alias("u"), first["metadata"]["finish_reason"].alias("finish_reason")
    ).select("doc_id", "u.*", "finish_reason")


@query(
    "F24 F15 P12",
    f"""SELECT doc_id, first_text, p + a + b AS chat_total, doc_id::VARCHAR AS request_id,
        CASE WHEN b >= m THEN 'length' ELSE 'stop' END AS second_reason, 1 AS second_index,
        greatest(a, b) AS longest, 'llm/v1/chat' AS route_type FROM {_ANSWERS}""",
)
def service_records(spark, sf):
    chat = responses.candidates_response("t", "n", "p", F.col("m"), "stand-in")
    text_record = responses.text_completion("doc_id", "t", "n", "p", F.col("m"), "stand-in")
    return answered(spark, sf).select("doc_id", chat.alias("c"), text_record.alias("r")).select(
        "doc_id",
        responses.first_candidate("c.candidates").alias("first_text"),
        F.col("c.metadata.total_tokens").alias("chat_total"),
        F.col("r.request_id").alias("request_id"),
        F.get("r.choices", F.lit(1))["finish_reason"].alias("second_reason"),
        F.get("r.choices", F.lit(1))["index"].alias("second_index"),
        F.col("r.usage.longest_completion_tokens").alias("longest"),
        F.col("c.metadata.route_type").alias("route_type"),
    )


@query(
    "F16",
    """SELECT doc_id, CASE WHEN lang = 'en' THEN text ELSE source || ' ' || text END AS by_text,
       array_to_string(regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]'), ' ') AS by_tokens FROM documents""",
)
def drop_prompt(spark, sf):
    head = F.concat("source", F.lit(" "))
    output = F.concat(head, "text")
    prompt = F.when(F.col("lang") == "en", head).otherwise(F.concat(head, F.lit("{")))
    by_tokens = text.drop_prompt_tokens(tokens.tokens(output), tokens.tokens(head))
    return texts(spark, sf, "documents").select(
        "doc_id", text.drop_prompt(output, prompt).alias("by_text"), F.array_join(by_tokens, " ").alias("by_tokens")
    )


@query(
    "F14",
    """SELECT event_id, '[' || strftime(ts, '%d/%m/%Y %H:%M:%S') || '] bot: ' || upper(event_type) AS line FROM events""",
)
def stamped_responses(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", text.stamped(F.upper("event_type"), "bot", F.col("ts")).alias("line"))


@query(
    "F18",
    """WITH s AS (SELECT event_id, round(value * 1000 * 1000000)::BIGINT AS us FROM events)
       SELECT event_id, CASE WHEN us // 86400000000 = 0 THEN '' WHEN us // 86400000000 = 1 THEN '1 day, '
              ELSE (us // 86400000000)::VARCHAR || ' days, ' END
           || ((us // 3600000000) % 24)::VARCHAR || ':' || lpad(((us // 60000000) % 60)::VARCHAR, 2, '0') || ':'
           || lpad(((us // 1000000) % 60)::VARCHAR, 2, '0')
           || CASE WHEN us % 1000000 = 0 THEN '' ELSE '.' || lpad((us % 1000000)::VARCHAR, 6, '0') END AS elapsed
       FROM s""",
)
def elapsed_times(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", text.elapsed_text(F.col("value") * 1000).alias("elapsed"))


@query(
    "F24 A6",
    f"""SELECT doc_id, CASE WHEN lang = 'es' THEN NULL ELSE doc_id::VARCHAR END AS id,
        CASE WHEN lang = 'es' THEN 'Assistant' ELSE 'assistant' END AS role, source AS content,
        CASE WHEN lang = 'es' THEN 'Usage Policy Violation' ELSE 'stop' END AS finish_reason,
        CASE WHEN lang = 'es' THEN NULL ELSE {n_tokens_sql('text', None)} + {n_tokens_sql('source', None)} END AS total_tokens
        FROM documents""",
)
def completion_records(spark, sf):
    record = responses.completion(
        "doc_id", F.lit(0), "stand-in", "source", F.lit("stop"), tokens.n_tokens("text", None), tokens.n_tokens("source", None)
    )
    r = F.when(F.col("lang") == "es", responses.policy_violation("source")).otherwise(record)
    rows = texts(spark, sf, "documents").select("doc_id", r.alias("r"))
    choice = F.get(F.col("r.choices"), F.lit(0))
    return rows.select(
        "doc_id",
        F.col("r.id").alias("id"),
        choice["message"]["role"].alias("role"),
        choice["message"]["content"].alias("content"),
        choice["finish_reason"].alias("finish_reason"),
        F.col("r.usage.total_tokens").alias("total_tokens"),
    )
