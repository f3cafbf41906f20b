"""Moderation, safe chat, personal data, the inference log."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import chat, moderation, pii, recognisers
from ..functions import templates as t
from ..models import standins
from ..operators import chats as ops
from ..operators import guard
from ..session import run_path
from ..streaming import inference_log
from .chats import CHATS_SQL, TURNS_SQL, assembled
from .registry import query, quoted, strip_sql, summary_sql, table, texts

TAXONOMY = standins.TAXONOMY

_MOD_HEAD = (
    "'[INST] Task: Check if there is unsafe content in ''' || judged || ''' messages in conversations according our "
    "safety policy with the below categories.' || E'\\n\\n<BEGIN UNSAFE CONTENT CATEGORIES>\\n' || "
    + quoted(TAXONOMY)
    + " || E'\\n<END UNSAFE CONTENT CATEGORIES>\\n\\n<BEGIN CONVERSATION>\\n\\n'"
)
_MOD_TAIL = (
    "E'<END CONVERSATION>\\n\\nProvide your safety assessment for ' || judged || E' in the above conversation:\\n"
    "- First line must read ''safe'' or ''unsafe''.\\n"
    "- If unsafe, a second line must include a comma-separated list of violated categories. [/INST]'"
)


@query(
    "A9 R13 W4",
    f"""WITH {TURNS_SQL}, j AS (SELECT conv_id, CASE WHEN count(*) % 2 = 0 THEN 'Agent' ELSE 'User' END AS judged,
            string_agg(CASE WHEN place % 2 = 0 THEN 'User' ELSE 'Agent' END || ': ' || text || chr(10) || chr(10), ''
                       ORDER BY place) AS body FROM turns GROUP BY conv_id)
        SELECT conv_id, {_MOD_HEAD} || body || {_MOD_TAIL} AS prompt FROM j""",
)
def moderation_prompt(spark, sf):
    return ops.moderation_prompts(assembled(spark, sf), TAXONOMY).select("conv_id", "prompt")


def whole_chat_sql(json: str, taxonomy: str = quoted(t.DEFAULT_TAXONOMY)) -> str:
    gap = " " * 10
    return (
        "'[INST] Task: Check for unsafe content in ''Agent'' messages in conversations according to our safety policy.' || "
        f"E'\\n{gap}<BEGIN UNSAFE CONTENT CATEGORIES>\\n{gap}' || {taxonomy} || "
        f"E'\\n{gap}<END UNSAFE CONTENT CATEGORIES>\\n{gap}<BEGIN CONVERSATION>\\n{gap}' || {json} || "
        f"E'\\n{gap}<END CONVERSATION>\\n{gap}Provide your safety assessment for Agent in the above conversation:\\n"
        f"{gap}- First line must read ''safe'' or ''unsafe''.\\n"
        f"{gap}- If unsafe, a second line must include a comma-separated list of violated categories. [/INST]'"
    )


@query(
    "R14",
    f"WITH {CHATS_SQL} SELECT conv_id, {whole_chat_sql('to_json(m)::VARCHAR')} AS prompt FROM chats",
)
def moderation_prompt_whole_chat(spark, sf):
    return assembled(spark, sf).select("conv_id", chat.moderation_prompt_whole_chat("messages").alias("prompt"))


# Guard answers by role: padded, with one code, with two, with one outside the taxonomy.
VERDICT_SQL = """(SELECT conv_id, turn, CASE WHEN role = 'system' THEN E' Safe \\n'
    WHEN role = 'user' THEN CASE WHEN length(text) < 200 THEN E'unsafe\\n O3 ' ELSE E'unsafe\\nO10\\nmore' END
    WHEN length(text) < 500 THEN E'unsafe\\nO1,O3' WHEN length(text) < 900 THEN E'unsafe\\nO77' ELSE 'unsafe' END AS v
    FROM conversations)"""


def verdicts(spark, sf):
    n = F.length("text")
    v = (
        F.when(F.col("role") == "system", " Safe \n")
        .when((F.col("role") == "user") & (n < 200), "unsafe\n O3 ")
        .when(F.col("role") == "user", "unsafe\nO10\nmore")
        .when(n < 500, "unsafe\nO1,O3")
        .when(n < 900, "unsafe\nO77")
        .otherwise("unsafe")
    )
    return table(spark, sf, "conversations").select("conv_id", "turn", v.alias("v"))


_PARTS = f"""p AS (SELECT conv_id, turn, {strip_sql('v')} AS v FROM {VERDICT_SQL}),
    c AS (SELECT conv_id, turn, lower(string_split(v, chr(10))[1]) = 'safe' AS is_safe,
                 {strip_sql('string_split(v, chr(10))[2]')} AS code FROM p)"""


@query("F7", f"WITH {_PARTS} SELECT * FROM c")
def guard_verdicts(spark, sf):
    return verdicts(spark, sf).select(
        "conv_id", "turn", moderation.is_safe("v").alias("is_safe"), moderation.violation_code("v").alias("code")
    )


_UNKNOWN = quoted(t.UNKNOWN_CATEGORY)


def _lookup(kind: str, sql_map: str):
    return f"""WITH {_PARTS}, tax(code, description) AS (VALUES {sql_map})
        SELECT conv_id, turn, coalesce(description, {_UNKNOWN}) AS category,
        (SELECT string_agg(coalesce((SELECT description FROM tax WHERE tax.code = w.x), {_UNKNOWN}), '|' ORDER BY w.i)
         FROM (SELECT unnest(string_split(c.code, ',')) AS x, generate_subscripts(string_split(c.code, ','), 1) AS i) w) AS categories
        FROM c LEFT JOIN tax ON c.code = tax.code"""


def _categories(spark, sf, variant):
    coded = verdicts(spark, sf).withColumn("code", moderation.violation_code("v"))
    taxonomy = F.lit(TAXONOMY)
    return coded.select(
        "conv_id",
        "turn",
        moderation.category("code", taxonomy, variant).alias("category"),
        F.array_join(moderation.categories("code", taxonomy, variant), "|").alias("categories"),
    )


@query(
    "F8 J5",
    _lookup(
        "block",
        "('O1', 'Violence.'), ('O2', 'Self-harm.'), ('O3', 'Crime planning!'), "
        "('O10', 'Weapons' || chr(10) || '- no sentence mark in the first line')",
    ),
)
def taxonomy_blocks(spark, sf):
    return _categories(spark, sf, "block")


@query("F9 J5", _lookup("sentence", "('O1', 'Violence.'), ('O2', 'Self-harm.'), ('O3', 'Crime planning!')"))
def taxonomy_sentences(spark, sf):
    return _categories(spark, sf, "sentence")


@query(
    "F10",
    f"""WITH {_PARTS} SELECT conv_id, turn, 'User''s prompt classified as ' || code || '. Fails safety measures.' AS prompt_message,
        'Model''s response classified as ' || code || '; fails safety measures.' AS response_message FROM c""",
)
def violation_messages(spark, sf):
    coded = verdicts(spark, sf).withColumn("code", moderation.violation_code("v"))
    return coded.select(
        "conv_id",
        "turn",
        moderation.prompt_violation("code").alias("prompt_message"),
        moderation.response_violation("code", "clause").alias("response_message"),
    )


def guard_sql(judged: str) -> str:
    """The stand-in guard's codes for a text, or an empty string."""
    tests = [
        f"CASE WHEN regexp_matches({judged}, '\\b(?:{words})\\b') THEN '{code}' END"
        for code, words in standins.GUARD_WORDS.items()
    ]
    return f"concat_ws(',', {', '.join(tests)})"


def category_sql(code: str, taxonomy: dict[str, str]) -> str:
    cases = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in taxonomy.items())
    return f"CASE {code} {cases} ELSE {_UNKNOWN} END"


_SENTENCES = {"O1": "Violence.", "O2": "Self-harm.", "O3": "Crime planning!"}


@query(
    "N14 F7 J5",
    f"""WITH {TURNS_SQL}, j AS (SELECT conv_id, string_agg(CASE WHEN place % 2 = 0 THEN 'User' ELSE 'Agent' END || ': ' || text
            || chr(10) || chr(10), '' ORDER BY place) AS body FROM turns GROUP BY conv_id),
        g AS (SELECT conv_id, nullif({guard_sql('body')}, '') AS code FROM j)
        SELECT conv_id, code IS NULL AS is_safe, code,
        CASE WHEN code IS NOT NULL THEN {category_sql('code', _SENTENCES)} END AS category FROM g""",
)
def guard_scores(spark, sf):
    parts = ops.guard_parts(table(spark, sf, "conversations"), TAXONOMY)
    scored = guard.score(parts, "prompt", standins.guard, F.lit(TAXONOMY))
    return guard.per_chat(scored, "conv_id", F.lit(TAXONOMY)).select("conv_id", "is_safe", "code", "category")


def _json(extra: str = "") -> str:
    return f"to_json(m{extra})::VARCHAR"


_SAFE_CHAT_SQL = f"""WITH {CHATS_SQL},
    r AS (SELECT conv_id, m, len(m) > 3 AS checked, len(m) > 5 AS masked, {_json()} AS j FROM chats),
    a AS (SELECT *, {summary_sql('j')} AS answer, nullif({guard_sql('j')}, '') AS code FROM r),
    b AS (SELECT *, nullif({guard_sql("j || answer")}, '') AS code2 FROM a)
    SELECT conv_id, CASE WHEN checked AND code IS NOT NULL THEN 'prompt blocked'
        WHEN checked AND code2 IS NOT NULL THEN 'answer blocked' ELSE 'answered' END AS outcome,
        CASE WHEN checked AND code IS NOT NULL THEN 'User''s prompt classified as ' || {category_sql('code', _SENTENCES)} || '. Fails safety measures.'
             WHEN checked AND code2 IS NOT NULL THEN 'Model''s response classified as ' || {category_sql('code2', _SENTENCES)} || '. Fails safety measures.'
             ELSE answer END AS content,
        CASE WHEN checked AND coalesce(code, code2) IS NOT NULL THEN 'Usage Policy Violation' ELSE 'stop' END AS finish_reason,
        CASE WHEN checked AND coalesce(code, code2) IS NOT NULL THEN 'Assistant' ELSE 'assistant' END AS role,
        CASE WHEN NOT (checked AND coalesce(code, code2) IS NOT NULL) THEN conv_id::VARCHAR || '-0' END AS id FROM b"""


@query("N15 P10 P13 F10 F24 F20 UD3", _SAFE_CHAT_SQL)
def safe_chat(spark, sf):
    n = F.size("messages")
    requests = assembled(spark, sf).select(
        "conv_id",
        F.concat(F.col("conv_id").cast("string"), F.lit("-0")).alias("request_id"),
        "messages",
        F.when(n > 3, True).alias("enable_safety_filter"),
        (n > 5).alias("enable_pii_filter"),
        F.lit(TAXONOMY).alias("unsafe_categories"),
    )
    answered = guard.safe_chat(
        requests.drop("conv_id"),
        standins.answer_generator,
        standins.guard,
        "request_id",
        "stand-in",
        F.lit(0),
    )
    choice = F.get(F.col("response.choices"), F.lit(0))
    return answered.select(
        F.substring_index("request_id", "-", 1).cast("bigint").alias("conv_id"),
        "outcome",
        choice["message"]["content"].alias("content"),
        choice["finish_reason"].alias("finish_reason"),
        choice["message"]["role"].alias("role"),
        F.col("response.id").alias("id"),
    )


def mask_sql(expression: str) -> str:
    """The masking rules, written out for RE2."""
    octet = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
    rules = [
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "<EMAIL_ADDRESS>"),
        (rf"\b(?:{octet}\.){{3}}{octet}\b", "<IP_ADDRESS>"),
        (r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b", "<IBAN_CODE>"),
        (r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b", "<CREDIT_CARD>"),
        (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "<US_SSN>"),
        (r"(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}\b", "<PHONE_NUMBER>"),
        (r"\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b", "<PHONE_NUMBER>"),
    ]
    for pattern, mark in rules:
        expression = f"regexp_replace({expression}, '{pattern}', '{mark}', 'g')"
    return expression


@query("F20", f"SELECT doc_id, {mask_sql('text')} AS masked FROM documents")
def pii_mask(spark, sf):
    return texts(spark, sf, "documents").select("doc_id", pii.mask_pii("text").alias("masked"))


@query(
    "Z1 K10 N14",
    f"""WITH g AS (SELECT nullif({guard_sql("'User: ' || text || chr(10)")}, '') AS code FROM conversations)
        SELECT code, {category_sql('code', _SENTENCES)} AS category, count(*) AS n_messages FROM g
        WHERE code IS NOT NULL GROUP BY ALL""",
)
def inference_log_monitor(spark, sf):
    schema = table(spark, sf, "conversations").schema
    requests = inference_log.read_requests(spark, sf, schema, "conversations.parquet")
    judged = inference_log.judged(requests, "role", "text", standins.guard, F.lit(TAXONOMY))
    path = run_path(spark, "inference-log")
    stream = inference_log.append(judged, f"{path}/table", f"{path}/checkpoint")
    stream.awaitTermination()
    return inference_log.monitor(spark.read.parquet(f"{path}/table"))


# A document with a card number made of its id in front, and one of ten of them passes the test of cards.
_CARD_TEXT = "('pay by card ' || (4000000000000000 + doc_id * 7919)::VARCHAR || ' or write: ' || text)"
_DIGITS = "list_transform(string_split(reverse(regexp_replace(c, '[^0-9]', '', 'g')), ''), lambda d: d::INT)"
_LUHN = f"""list_sum(list_transform({_DIGITS}, lambda d, i:
    CASE WHEN i % 2 = 1 THEN d WHEN d > 4 THEN d * 2 - 9 ELSE d * 2 END)) % 10 = 0"""


@query(
    "F20",
    f"""SELECT doc_id, len(list_filter(regexp_extract_all({_CARD_TEXT}, '{recognisers.CARD}'), lambda c: {_LUHN}))::BIGINT AS n_cards,
        len(regexp_extract_all({_CARD_TEXT}, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+'))::BIGINT AS n_mails,
        true AS masked FROM documents""",
)
def entity_spans(spark, sf):
    """Cards that pass the Luhn test and mail addresses, as spans; masking them leaves none."""
    written = F.concat(F.lit("pay by card "), (F.lit(4000000000000000) + F.col("doc_id") * 7919).cast("string"), F.lit(" or write: "), "text")
    rows = texts(spark, sf, "documents").select("doc_id", written.alias("t"))
    rows = rows.withColumn("s", recognisers.find_entities("t", ["CREDIT_CARD", "EMAIL_ADDRESS"]))
    rows = rows.withColumn("left", recognisers.find_entities(recognisers.mask_spans("t", F.col("s")), ["CREDIT_CARD", "EMAIL_ADDRESS"]))

    def count(entity):
        return F.size(F.filter("s", lambda s: s["entity"] == entity)).cast("bigint")

    return rows.select("doc_id", count("CREDIT_CARD").alias("n_cards"), count("EMAIL_ADDRESS").alias("n_mails"), (F.size("left") == 0).alias("masked"))
