"""Deterministic sampling, splits, batch inference and its statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import prompts, text, tokens
from ..functions import templates as t
from ..models import standins
from ..operators import sample, stats
from ..operators.generate import generate
from ..sources import readers
from .registry import n_tokens_sql, query, quoted, strip_sql, summary_sql, table, texts

PROMPT_SQL = (
    quoted("<s>[INST]<<SYS>>\n" + t.CONCISE_SYSTEM_PROMPT + "\n<</SYS>>\n\n"
           "Please provide a concise summary for the following article: ")
    + " || text || "
    + quoted("\n[/INST]\n")
)


@query(
    "T1 F11 T5",
    """SELECT doc_id, sha256(doc_id::VARCHAR) AS random_string
       FROM documents ORDER BY random_string LIMIT 100""",
)
def sample_hash(spark, sf):
    rows = sample.sample_rows(table(spark, sf, "documents"), "doc_id", 100)
    return sample.spread(rows, 4).select(
        "doc_id", text.sha256_hex(F.col("doc_id").cast("string")).alias("random_string")
    )


@query(
    "T4",
    """SELECT doc_id, source FROM documents
       ORDER BY sha256(doc_id::VARCHAR || chr(31) || '7') LIMIT 50""",
)
def sample_seeded(spark, sf):
    return sample.sample_rows(table(spark, sf, "documents"), "doc_id", 50, seed=7).select("doc_id", "source")


@query(
    "T3 W1",
    """SELECT doc_id, row_number() OVER (ORDER BY sha256(doc_id::VARCHAR || chr(31) || '42')) - 1 AS position
       FROM documents""",
)
def shuffle_positions(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id")
    return sample.with_position(docs, "doc_id", seed=42)


@query("S6", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 500")
def split_slice(spark, sf):
    return sample.first_rows(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 500)


@query("T2 K7", "SELECT doc_id, source FROM documents ORDER BY n_chars DESC, doc_id LIMIT 50")
def preview_longest(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return sample.preview(docs, [F.desc("n_chars"), "doc_id"], 50).drop("n_chars")


def _split_sql(n_test: str) -> str:
    return f"""SELECT doc_id, CASE WHEN row_number() OVER (
                   ORDER BY sha256(doc_id::VARCHAR || chr(31) || '68')) <= {n_test}
                   THEN 'test' ELSE 'train' END AS split FROM documents"""


@query("T6", _split_sql("(SELECT ceil(count(*) * 0.2) FROM documents)"))
def split_fraction(spark, sf):
    return sample.train_test_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 0.2)


@query("T6", _split_sql("75"))
def split_absolute(spark, sf):
    return sample.train_test_split(table(spark, sf, "documents").select("doc_id"), "doc_id", 75)


@query(
    "S4 S7 S8 A2",
    """SELECT CASE WHEN lang IN ('en', 'fr') THEN 'train' ELSE 'test' END AS split, count(*) AS n_rows FROM documents GROUP BY 1""",
)
def existing_splits(spark, sf):
    docs = table(spark, sf, "documents")
    splits = readers.tagged(
        {"train": docs.where("lang in ('en', 'fr')"), "test": docs.where("lang not in ('en', 'fr')")}
    )
    train, test = readers.load_or_split(splits, "documents", "doc_id")
    return stats.rows_per_split(readers.tagged({"train": train, "test": test}))


@query(
    "S8 T6 A2",
    """WITH n AS (SELECT count(*) AS n, ceil(count(*) * 0.2) AS k FROM documents)
       SELECT 'test' AS split, k::BIGINT AS n_rows FROM n UNION ALL SELECT 'train', (n - k)::BIGINT FROM n""",
)
def made_splits(spark, sf):
    train, test = readers.load_or_split(table(spark, sf, "documents"), "documents", "doc_id")
    return stats.rows_per_split(readers.tagged({"train": train, "test": test}))


@query("R1 P1", f"SELECT doc_id, {PROMPT_SQL} AS instruction FROM documents")
def summary_prompt(spark, sf):
    return table(spark, sf, "documents").select("doc_id", prompts.summary("text").alias("instruction"))


def _inference_sql(rows: str) -> str:
    return f"""WITH d AS (SELECT doc_id, text AS article, {PROMPT_SQL} AS instruction FROM {rows}),
        g AS (SELECT *, {summary_sql('instruction')} AS cleaned_llm_summary FROM d),
        c AS (SELECT doc_id, cleaned_llm_summary, 'ok' AS status,
                     {n_tokens_sql('article', 2048)}::INTEGER AS article_token_count,
                     {n_tokens_sql('instruction', 2048)}::INTEGER AS instruction_token_count,
                     {n_tokens_sql('cleaned_llm_summary', 2048)}::INTEGER AS generated_token_count FROM g)"""


def infer(rows):
    """Prompt, generate with the stand-in model, clean, count tokens."""
    prompted = rows.select("doc_id", F.col("text").alias("article")).withColumn(
        "instruction", prompts.summary("article")
    )
    generated = generate(
        prompted, "instruction", "cleaned_llm_summary", standins.echo_generator, clean=text.after_last
    )
    return stats.token_columns(
        generated,
        {
            "article_token_count": "article",
            "instruction_token_count": "instruction",
            "generated_token_count": "cleaned_llm_summary",
        },
        cap=tokens.MAX_TOKENS,  # what the job's model sees of a text
    )


@query(
    "S1 T1 R1 N13 UD3 F1 F12 N1",
    _inference_sql("(SELECT * FROM documents ORDER BY sha256(doc_id::VARCHAR) LIMIT (SELECT greatest(100, count(*) // 10) FROM documents))")
    + " SELECT * FROM c",
)
def batch_inference(spark, sf):
    """Over a tenth of the documents, 100 at least."""
    rows = sample.sample_rows(table(spark, sf, "documents"), "doc_id", lambda n: max(100, n // 10))
    return infer(rows).drop("article", "instruction", "error")


@query(
    "A1 N1 N13",
    _inference_sql("documents")
    + """ SELECT count(doc_id) AS articles_count, sum(article_token_count)::BIGINT AS total_article_tokens,
          sum(instruction_token_count)::BIGINT AS total_instruction_tokens,
          sum(generated_token_count)::BIGINT AS total_generated_tokens FROM c""",
)
def batch_stats(spark, sf):
    return stats.text_stats(infer(texts(spark, sf, "documents")), "doc_id", status="status")


@query("N1", f"SELECT doc_id, {n_tokens_sql('text', 2048)}::INTEGER AS n_tokens, {n_tokens_sql('text', None)}::INTEGER AS n_all FROM documents")
def token_counts(spark, sf):
    docs = texts(spark, sf, "documents")
    counted = stats.token_columns(docs, {"n_tokens": "text"}, cap=tokens.MAX_TOKENS)
    return stats.token_columns(counted, {"n_all": "text"}, cap=None).select("doc_id", "n_tokens", "n_all")


# Generations with the marker twice, at the start, and not at all, by language.
GENERATION_SQL = """(SELECT doc_id, lang, CASE lang
    WHEN 'en' THEN '[INST] ' || source || ' [/INST]' || chr(10) || text || '[/INST]' || chr(10) || chr(160) || source || chr(10)
    WHEN 'de' THEN '[/INST] ' || text || '[inst}'
    WHEN 'fr' THEN ' ' || text || ' '
    ELSE 'Q ### Response: ' || text || chr(10) || '### End of ' || source END AS x FROM documents)"""


def generations(spark, sf):
    source, body, line = F.col("source"), F.col("text"), F.lit("\n")
    x = (
        F.when(
            F.col("lang") == "en",
            F.concat(
                F.lit("[INST] "), source, F.lit(" [/INST]"), line, body, F.lit("[/INST]"), line,
                F.lit("\u00a0"), source, line,
            ),
        )
        .when(F.col("lang") == "de", F.concat(F.lit("[/INST] "), body, F.lit("[inst}")))
        .when(F.col("lang") == "fr", F.concat(F.lit(" "), body, F.lit(" ")))
        .otherwise(F.concat(F.lit("Q ### Response: "), body, line, F.lit("### End of "), source))
    )
    return texts(spark, sf, "documents").select("doc_id", x.alias("x"))


@query("F1 F12", f"SELECT doc_id, {strip_sql('''string_split(x, '[/INST]')[-1]''')} AS answer FROM {GENERATION_SQL}")
def clean_after_last(spark, sf):
    return generations(spark, sf).select("doc_id", text.after_last("x").alias("answer"))


@query(
    "F2 F13",
    f"""SELECT doc_id, replace(CASE WHEN instr(x, '[/INST]') > 1
        THEN {strip_sql("substr(x, instr(x, '[/INST]') + 7)")} ELSE x END, '[inst}}', '') AS answer
        FROM {GENERATION_SQL}""",
)
def clean_after_first(spark, sf):
    return generations(spark, sf).select("doc_id", text.after_first("x").alias("answer"))


@query(
    "F3",
    f"""SELECT doc_id, string_split(x, '[/INST]' || chr(10))[2] AS answer,
        CASE WHEN contains(x, '[/INST]' || chr(10)) THEN 'ok' ELSE 'no marker' END AS status
        FROM {GENERATION_SQL}""",
)
def clean_second_piece(spark, sf):
    answer = text.after_separator("x")
    return generations(spark, sf).select(
        "doc_id",
        answer.alias("answer"),
        F.when(answer.isNull(), "no marker").otherwise("ok").alias("status"),
    )


@query(
    "F4",
    f"""WITH g AS (SELECT doc_id, CASE WHEN instr(x, '### Response:') > 0
            THEN substr(x, instr(x, '### Response:') + 13) END AS tail FROM {GENERATION_SQL})
        SELECT doc_id, {strip_sql("CASE WHEN instr(tail, '### End') > 0 THEN substr(tail, 1, instr(tail, '### End') - 1) ELSE tail END")}
            AS answer FROM g""",
)
def extract_response(spark, sf):
    return generations(spark, sf).select("doc_id", text.between("x").alias("answer"))


@query(
    "F17",
    r"""WITH h AS (SELECT doc_id, text, least(
            CASE WHEN instr(text, '. ') > 0 THEN instr(text, '. ') ELSE 2000000000 END,
            CASE WHEN instr(text, chr(10)) > 0 THEN instr(text, chr(10)) ELSE 2000000000 END) AS p FROM documents)
       SELECT doc_id, CASE WHEN p = 2000000000 THEN text ELSE substr(text, 1, p - 1) END AS answer FROM h""",
)
def stop_words(spark, sf):
    return texts(spark, sf, "documents").select(
        "doc_id", text.cut_at_stop("text", ["", ". ", "\n"]).alias("answer")
    )
