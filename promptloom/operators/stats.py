"""Counts and throughput."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import tokens


def token_columns(df: DataFrame, counts: dict[str, str], cap: int | None = None) -> DataFrame:
    """Add token counts: ``{new column: text column}``."""
    return df.withColumns({name: tokens.n_tokens(text, cap) for name, text in counts.items()})


def text_stats(
    df: DataFrame,
    id_col: str = "id",
    article: str = "article_token_count",
    instruction: str = "instruction_token_count",
    generated: str = "generated_token_count",
    status: str | None = None,
) -> DataFrame:
    """One row of totals. With ``status``, generated tokens count for successful rows only.

    The names of the totals are fixed values: reports on batch jobs are read by these names.
    """
    ok = F.col(generated) if status is None else F.when(F.col(status) == "ok", F.col(generated))
    return df.agg(
        F.count(id_col).alias("articles_count"),
        F.sum(article).alias("total_article_tokens"),
        F.sum(instruction).alias("total_instruction_tokens"),
        F.sum(ok).alias("total_generated_tokens"),
    )


def rows_per_split(df: DataFrame, split: str = "split") -> DataFrame:
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("n_rows"))


# Ways to count the tokens of a generation.
COUNTINGS = ("with_prompt", "minus_prompt", "completion")


def throughput(timed: DataFrame, prompt_tokens: Column, output_tokens: Column, completion_tokens: Column) -> DataFrame:
    """``counting, n_tokens, seconds, tokens_per_second`` of a timed generation, all from one pass over it.

    ``with_prompt`` counts prompt and completion as they were given back, ``minus_prompt`` the output's length less
    the prompt's, ``completion`` the tokens of the completion by itself.
    """
    counts = dict(zip(COUNTINGS, (output_tokens, output_tokens - prompt_tokens, completion_tokens)))
    totals = timed.agg(*[F.sum(n).alias(name) for name, n in counts.items()], F.sum("seconds").alias("seconds"))
    rows = F.explode(F.array(*[F.struct(F.lit(n).alias("counting"), F.col(n).cast("long").alias("n_tokens")) for n in COUNTINGS]))
    return totals.select(rows.alias("r"), "seconds").select(
        "r.counting", "r.n_tokens", "seconds", (F.col("r.n_tokens") / F.col("seconds")).alias("tokens_per_second")
    )
