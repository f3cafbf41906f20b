"""Instruction records: templates, merging, deduplication, tokenizing, shards."""

from __future__ import annotations

import math

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import prompts
from ..functions import templates as t
from ..functions.text import strip
from ..operators import dedup, sample, tokenize
from ..session import run_path
from ..sources import readers, writers
from ..sources.readers import balanced
from .registry import TOKEN_SQL, query, quoted, table, texts

I = quoted(t.INTRO)

# Instruction records from documents: the context is a text, empty, or null, by language.
RECORDS_SQL = """(SELECT doc_id, 'Describe a text from ' || source || '.' AS instruction,
    CASE lang WHEN 'en' THEN text WHEN 'de' THEN '' END AS context,
    'It has ' || n_chars || ' characters, {braces} and \\.' AS response FROM documents)"""


def records(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.concat(F.lit("Describe a text from "), "source", F.lit(".")).alias("instruction"),
        F.when(F.col("lang") == "en", F.col("text")).when(F.col("lang") == "de", F.lit("")).alias("context"),
        F.concat(F.lit("It has "), F.col("n_chars").cast("string"), F.lit(" characters, {braces} and \\.")).alias(
            "response"
        ),
    )


@query(
    "R3 R4 P8",
    f"""SELECT doc_id, CASE WHEN coalesce(context, '') <> ''
        THEN {I} || E'\\n\\n### Instruction:\\n' || instruction || E'\\n\\nInput:\\n' || context
             || E'\\n\\n### Response:\\n' || response || E'\\n\\n### End'
        ELSE {I} || E'\\n\\n### Instruction:\\n' || instruction
             || E'\\n\\n### Response:\\n' || response || E'\\n\\n### End' END AS text FROM {RECORDS_SQL}""",
)
def training_text(spark, sf):
    return records(spark, sf).select(
        "doc_id", prompts.training_text("instruction", "response", "context").alias("text")
    )


@query(
    "R5",
    f"""SELECT doc_id, '{{ ''prompt'': ' || {I} || E'\\n\\n### Instruction:\\n' || instruction
        || CASE WHEN coalesce(context, '') <> '' THEN E'\\n\\nInput:\\n' || context ELSE '' END
        || E'\\n\\n### Response:, ''response'': ' || response || ' }}' AS text FROM {RECORDS_SQL}""",
)
def pair_text(spark, sf):
    return records(spark, sf).select(
        "doc_id", prompts.pair_text("instruction", "response", "context").alias("text")
    )


@query(
    "R6",
    f"""SELECT doc_id, {I} || E'\\n### Instruction:\\n' || instruction
        || CASE WHEN coalesce(context, '') <> '' THEN E'\\nInput:\\n' || context ELSE '' END
        || E'\\n### Response:\\n' || response AS text FROM {RECORDS_SQL}""",
)
def compact_text(spark, sf):
    return records(spark, sf).select(
        "doc_id", prompts.compact_text("instruction", "response", "context").alias("text")
    )


@query(
    "R7",
    f"""SELECT doc_id,
        {I} || E'\\n        ### Instruction:\\n        ' || instruction || E'\\n        ### Response:\\n        ' AS wide,
        {I} || E'\\n\\n  ### Instruction:\\n  ' || instruction || E'\\n\\n  ### Response:\\n  ' AS narrow,
        {I} || E'\\n\\n###Instruction\\n' || instruction || E'\\n\\n### Response\\n' AS hashed
        FROM {RECORDS_SQL}""",
)
def inference_prompts(spark, sf):
    return records(spark, sf).select(
        "doc_id",
        prompts.inference_prompt("instruction").alias("wide"),
        prompts.inference_prompt("instruction", 2, blank_lines=True).alias("narrow"),
        prompts.hash_instruction("instruction").alias("hashed"),
    )


_SYS = quoted(t.DEFAULT_SYSTEM_PROMPT)


@query(
    "R2",
    f"""SELECT doc_id,
        E'\\n<s>[INST]<<SYS>>\\n' || {_SYS} || E'\\n<</SYS>>\\n\\n' || instruction || E'\\n[/INST]\\n' AS standard,
        E'\\n<s>[INST]<<SYS>>\\n' || {_SYS} || E'\\n<</SYS>>\\n\\n\\n' || instruction || E'\\n[/INST]\\n' AS spaced,
        E'<s>[INST]<<SYS>>\\n' || {_SYS} || E'\\n<</SYS>>\\n\\n\\n' || instruction || E'[/INST]\\n' AS compact
        FROM {RECORDS_SQL}""",
)
def single_turn_prompts(spark, sf):
    forms = ["standard", "spaced", "compact"]
    return records(spark, sf).select(
        "doc_id", *[prompts.single_turn("instruction", form=f).alias(f) for f in forms]
    )


@query(
    "R15 R17",
    """SELECT doc_id,
       '<s>[INST] <<SYS>>Extract entities from the text below.<</SYS>> ' || text || ' [/INST] ' AS entities,
       E'\\n[INST] Write code to solve the following coding problem that obeys the constraints and passes the example '
       || E'test cases. Please wrap your code answer using ```:\\n' || text || E'\\n[/INST]\\n' AS code FROM documents""",
)
def task_prompts(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", prompts.entity_extraction("text").alias("entities"), prompts.code_task("text").alias("code")
    )


@query(
    "R22",
    f"""SELECT doc_id,
        E'[INST] Let''s think step by step. [/INST]\\n  User: ' || instruction || E'\\n  ' AS step_inst,
        E'User: Let''s think step by step.\\n    ' || instruction || E'\\n    Assistant:\\n    ' AS step_chat,
        instruction || E'\\n    Be Concise.\\n    ' AS concise,
        E'### Instruction:\\n' || {_SYS} || E'\\n' || instruction || E'\\n\\n### Response:\\n' AS system
        FROM {RECORDS_SQL}""",
)
def decorated_prompts(spark, sf):
    styles = ["step_inst", "step_chat", "concise", "system"]
    return records(spark, sf).select("doc_id", *[prompts.decorated("instruction", s).alias(s) for s in styles])


@query(
    "R18 R19 R20",
    """SELECT item_id, 'passage: ' || text AS passage, 'query: ' || text AS query,
       'query: ' || text AS query_twice,
       'Represent this sentence for searching relevant passages: ' || text AS bge, text AS bge_m3,
       'Represent the ' || CASE WHEN length(text) > 200 THEN 'science ' ELSE '' END || 'sentence'
       || CASE WHEN length(text) < 300 THEN ' for retrieval' ELSE '' END || ':' AS instructor FROM benchmark""",
)
def embedding_prefixes(spark, sf):
    n = F.length("text")
    return table(spark, sf, "benchmark").select(
        "item_id",
        prompts.passage("text").alias("passage"),
        prompts.query("text").alias("query"),
        prompts.query(prompts.query("text")).alias("query_twice"),
        prompts.bge_query("text").alias("bge"),
        prompts.bge_query("text", None).alias("bge_m3"),
        prompts.instructor(
            F.lit("sentence"), F.when(n > 200, "science"), F.when(n < 300, "retrieval")
        ).alias("instructor"),
    )


# Text-to-SQL records from the parts: some answers name no definite table.
SQL_RECORDS = """(SELECT p_partkey, 'Which parts are called ' || p_name || '?' AS question,
    ' CREATE TABLE part (p_name VARCHAR, p_brand VARCHAR) ' || p_type AS context,
    'SELECT * FROM ' || CASE WHEN p_type = 'SMALL' THEN 'table_1' ELSE 'part' END || ' WHERE p_name = ''' || p_name || '''' AS answer
    FROM part)"""


def sql_records(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        F.struct(
            F.concat(F.lit("Which parts are called "), "p_name", F.lit("?")).alias("question"),
            F.concat(F.lit(" CREATE TABLE part (p_name VARCHAR, p_brand VARCHAR) "), "p_type").alias("context"),
            F.concat(
                F.lit("SELECT * FROM "),
                F.when(F.col("p_type") == "SMALL", "table_1").otherwise("part"),
                F.lit(" WHERE p_name = '"),
                "p_name",
                F.lit("'"),
            ).alias("answer"),
        ).alias("train"),
    )


SQL_PAIRS = f"""SELECT DISTINCT {I} || E'\\n\\n### Instruction:\\nGenerate SQL query: ' || question
    || ', given the following schema: ' || trim(replace(replace(context, 'CREATE TABLE', ''), 'VARCHAR', 'STRING'))
    || E'\\n\\n### Response:\\n' AS prompt, answer AS response FROM {SQL_RECORDS}
    WHERE NOT contains(answer, 'FROM table_')"""


def sql_pairs(spark, sf):
    flat = readers.flatten(sql_records(spark, sf), "train")
    kept = flat.where(~F.col("answer").contains("FROM table_"))
    instruction = prompts.sql_instruction("question", "context")
    return kept.withColumn("prompt", prompts.dataset_prompt(instruction)).select(
        "prompt", F.col("answer").alias("response")
    )


@query("S11 P5 P6 R9 R10 F13 A3", SQL_PAIRS)
def text_to_sql(spark, sf):
    return dedup.drop_duplicate_rows(sql_pairs(spark, sf))


@query(
    "V1 V2 A3 P2 P3 P4 R9 R8",
    f"""WITH renamed AS (SELECT {I} || E'\\n\\n### Instruction:\\n' || instruction || E'\\n\\n### Response:\\n' AS prompt, response
              FROM {RECORDS_SQL}),
        talks AS (SELECT DISTINCT a.text AS prompt, b.text AS response FROM conversations a JOIN conversations b
              ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user' AND b.role = 'assistant'),
        pairs AS (SELECT * FROM renamed UNION SELECT * FROM talks UNION SELECT * FROM ({SQL_PAIRS}))
        SELECT prompt, response || E'\\n### End' AS response, prompt || response || E'\\n### End' AS text FROM pairs""",
)
def instruction_dataset(spark, sf):
    code = (
        records(spark, sf)
        .withColumn("prompt", prompts.dataset_prompt("instruction"))
        .withColumnRenamed("response", "completion")
        .drop("instruction", "context", "doc_id")
        .withColumnRenamed("completion", "response")
    )
    turns = table(spark, sf, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("prompt"))
    told = turns.where("role = 'assistant'").select("conv_id", "turn", F.col("text").alias("response"))
    talks = asked.join(told, ["conv_id", "turn"]).select("prompt", "response")
    merged = dedup.instruction_dataset(code, talks, sql_pairs(spark, sf), end_mark=t.END_OF_RESPONSE)
    return merged.withColumn("text", prompts.prompt_and_response("prompt", "response"))


@query(
    "V1 A2",
    "SELECT lang, 2 * count(*) AS n_rows FROM documents WHERE lang <> 'es' GROUP BY lang "
    "UNION ALL SELECT lang, count(*) FROM documents WHERE lang = 'es' GROUP BY lang",
)
def stacked_splits(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    parts = dedup.stack_splits(docs, docs.where("lang in ('en', 'de')"), docs.where("lang = 'fr'"))
    return parts.groupBy("lang").agg(F.count(F.lit(1)).alias("n_rows"))


@query("A4", "SELECT DISTINCT source FROM documents")
def unique_sources(spark, sf):
    return dedup.unique_values(table(spark, sf, "documents"), "source")


_IDS = f"""list_transform(list_slice(regexp_extract_all(x, '{TOKEN_SQL}'), 1, 256),
    lambda w: (('0x' || substr(md5(w), 1, 7))::UBIGINT % 32000)::INTEGER)"""


@query(
    "N2 N3 R8",
    f"""WITH i AS (SELECT doc_id, {_IDS} AS ids FROM (SELECT doc_id, instruction || response AS x FROM {RECORDS_SQL}))
        SELECT doc_id, array_to_string(list_concat(ids, list_transform(range(len(ids), 256), lambda z: 0::INTEGER)), ',') AS input_ids,
        len(ids)::INTEGER AS n_attended FROM i""",
)
def tokenize_pairs(spark, sf):
    rows = tokenize.tokenize_rows(
        balanced(records(spark, sf)),
        lambda: prompts.prompt_and_response("instruction", "response"),
        max_length=256,
        pad_to=256,
        keep=["doc_id"],
    )
    return rows.select(
        "doc_id",
        F.concat_ws(",", F.col("input_ids").cast("array<string>")).alias("input_ids"),
        F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_attended"),
    )


@query(
    "N2 P9",
    f"""SELECT doc_id, array_to_string({_IDS}, ',') AS input_ids FROM (SELECT doc_id, text AS x FROM documents)
        WHERE len(regexp_extract_all(x, '{TOKEN_SQL}')) >= 256""",
)
def tokenize_full_length(spark, sf):
    docs = texts(spark, sf, "documents")
    rows = tokenize.tokenize_rows(docs, "text", max_length=256, only_full=True, keep=["doc_id"])
    return rows.select("doc_id", F.concat_ws(",", F.col("input_ids").cast("array<string>")).alias("input_ids"))


@query("S11", "SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def flatten_props(spark, sf):
    schema = T.StructType([T.StructField("k", T.LongType())])
    return readers.flatten_json(table(spark, sf, "events"), "props", schema, ["event_id"])


@query(
    "K8 T6 A2",
    """WITH n AS (SELECT count(*) AS n, ceil(count(*) * 0.05) AS k, greatest(200, ceil(count(*) / 1000))::BIGINT AS s FROM documents)
       SELECT 'test' AS split, k::BIGINT AS n_rows, greatest(1, ceil(k / s))::BIGINT AS most_shards FROM n
       UNION ALL SELECT 'train', (n - k)::BIGINT, greatest(1, ceil((n - k) / s))::BIGINT FROM n""",
)
def training_shards(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", prompts.summary("text").alias("text"))
    parts = sample.train_test_split(rows, "doc_id", 0.05)
    # About a thousand shards whatever the table's size, of 200 rows at least.
    per_shard = max(200, math.ceil(rows.count() / 1000))
    manifest = writers.save_training_shards(parts, run_path(spark, "shards"), "doc_id", rows_per_shard=per_shard)
    return manifest.groupBy("split").agg(
        F.sum("n_rows").alias("n_rows"), (F.max("shard") + 1).cast("bigint").alias("most_shards")
    )


@query(
    "P7 F12",
    f"SELECT doc_id, length(trim(instruction))::INTEGER AS n FROM {RECORDS_SQL} WHERE length(context) > 1",
)
def long_contexts(spark, sf):
    kept = records(spark, sf).where(F.length("context") > 1)
    return kept.select("doc_id", F.length(strip("instruction")).alias("n"))
