"""Multi-turn chats: assembly, prompts, validity, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chat, prompts, responses
from ..functions import templates as t
from ..operators import chats as ops
from ..sources import readers
from .registry import query, quoted, table

# Turns with their place in the chat and facts about the whole chat.
TURNS_SQL = """placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role) - 1 AS place FROM conversations),
    turns AS (SELECT *,
        max(CASE WHEN place = 0 AND role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys,
        count(*) OVER (PARTITION BY conv_id) AS n FROM placed),
    facts AS (SELECT conv_id, max(sys) AS sys, max(n) AS n, arg_max(role, place) AS last_role,
        sum(CASE WHEN place < sys THEN 0
                 WHEN role = CASE WHEN (place - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END THEN 0
                 ELSE 1 END) AS wrong FROM turns GROUP BY conv_id),
    problems AS (SELECT *, CASE WHEN n = sys THEN 'empty' WHEN wrong > 0 THEN 'roles do not alternate'
        WHEN last_role <> 'user' THEN 'last message is not from user' END AS problem FROM facts)"""

CHATS_SQL = """chats AS (SELECT conv_id, list(struct_pack(role := role, content := text) ORDER BY turn) AS m
    FROM conversations GROUP BY conv_id)"""


def assembled(spark, sf):
    return ops.assemble_chats(table(spark, sf, "conversations"))


@query(
    "A9 R11 F23 W4 W5",
    f"""WITH {TURNS_SQL}
        SELECT conv_id, '<s>' || E'<<SYS>>\\n' ||
            coalesce(max(CASE WHEN place < p.sys THEN text END), {quoted(t.CHAT_SYSTEM_PROMPT)}) || E'\\n<</SYS>>\\n\\n'
            || string_agg(CASE WHEN place < p.sys THEN '' WHEN role = 'user' THEN '[INST]' || text || '[/INST]' ELSE text END,
                          '' ORDER BY place) AS prompt
        FROM turns JOIN problems p USING (conv_id) WHERE problem IS NULL GROUP BY conv_id""",
)
def chat_prompt(spark, sf):
    return ops.chat_prompts(assembled(spark, sf)).select("conv_id", "prompt")


@query(
    "F23 W5",
    f"WITH {TURNS_SQL} SELECT conv_id, n AS n_turns, sys = 1 AS has_system, problem FROM problems",
)
def chat_problems(spark, sf):
    return ops.chat_facts(table(spark, sf, "conversations")).drop("last_role")


@query(
    "W4 W5",
    f"""WITH {TURNS_SQL} SELECT conv_id, string_agg(CASE WHEN place % 2 = 0 THEN text END, '|' ORDER BY place) AS even_turns,
       coalesce(string_agg(CASE WHEN place % 2 = 1 THEN text END, '|' ORDER BY place), '') AS odd_turns,
       arg_max(role, place) AS last_role FROM turns GROUP BY conv_id""",
)
def turn_parity(spark, sf):
    def texts(start):
        return F.array_join(F.transform(chat.every_other("messages", start), lambda m: m["content"]), "|")

    return assembled(spark, sf).select(
        "conv_id",
        texts(0).alias("even_turns"),
        texts(1).alias("odd_turns"),
        chat.last_role("messages").alias("last_role"),
    )


@query(
    "R12 F19",
    """SELECT item_id, '[{"role":"system","content":"You are a helpful assistant."},{"role":"user","content":'
       || to_json(text)::VARCHAR || '}]' AS messages FROM benchmark""",
)
def default_system_chat(spark, sf):
    return table(spark, sf, "benchmark").select(
        "item_id", F.to_json(chat.with_system("text")).alias("messages")
    )


@query(
    "F19",
    f"""WITH {CHATS_SQL} SELECT conv_id, len(m) AS n, m[1].role AS first_role, m[-1].content AS last_text FROM chats""",
)
def chats_from_json(spark, sf):
    texts = assembled(spark, sf).select("conv_id", F.to_json("messages").alias("j"))
    parsed = texts.select("conv_id", readers.messages_column("j", is_json=True).alias("m"))
    return parsed.select(
        "conv_id",
        F.size("m").cast("bigint").alias("n"),
        F.get("m", F.lit(0))["role"].alias("first_role"),
        F.element_at("m", -1)["content"].alias("last_text"),
    )


@query(
    "P13",
    """SELECT conv_id, CASE WHEN count(*) > 4 THEN 0.5 ELSE 1.0 END::DOUBLE AS temperature,
       CASE WHEN max(role) = 'system' THEN 64 ELSE 100 END::BIGINT AS max_tokens,
       CASE WHEN count(*) > 6 THEN count(*) ELSE 1 END AS candidate_count FROM conversations GROUP BY conv_id""",
)
def request_defaults(spark, sf):
    n = F.col("n")
    requests = (
        table(spark, sf, "conversations")
        .groupBy("conv_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("role").alias("r"))
        .select(
            "conv_id",
            F.when(n > 4, F.lit(0.5)).alias("temperature"),
            F.when(F.col("r") == "system", F.lit(64).cast("bigint")).alias("max_tokens"),
            F.when(n > 6, n).alias("candidate_count"),
        )
    )
    return requests.select(
        "conv_id",
        responses.defaulted("temperature", 1.0).alias("temperature"),
        responses.defaulted("max_tokens", 100).alias("max_tokens"),
        responses.defaulted("candidate_count", 1).alias("candidate_count"),
    )


@query(
    "R16",
    """SELECT conv_id, turn, 'Use this: ' || role || ' {x}' || chr(10) || 'Q: ' || text || ' A:' AS prompt
       FROM conversations""",
)
def context_prompt(spark, sf):
    template = "Use this: {context} {{x}}\nQ: {question} A:"
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", prompts.with_context(template, "role", "text").alias("prompt")
    )
