"""Response records of chat and completion services."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import templates as t
from .text import col, finish_reason
from ..schemas import COMPLETION

# Fixed value: the route named in the metadata of chat responses.
CHAT_ROUTE = "llm/v1/chat"


def first_candidate(candidates: Column | str) -> Column:
    """Text of the first of ``[{message: {role, content}}]``; null when there is none."""
    return F.get(col(candidates), F.lit(0))["message"]["content"]


def defaulted(c: Column | str, default) -> Column:
    """A request parameter, row by row, or its default."""
    return F.coalesce(col(c), F.lit(default))


def json_response(c: Column | str, key: str = "response") -> Column:
    """``{"response": …}``; a missing answer is written as null, not left out."""
    return F.to_json(F.struct(col(c).alias(key)), {"ignoreNullFields": "false"})


def usage(prompt_tokens: Column | str, completion_lengths: Column | str) -> Column:
    """Token usage over all candidates: both the longest and the sum, and the total with the sum."""
    lengths = col(completion_lengths)
    total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda acc, n: acc + n)
    prompt = col(prompt_tokens).cast("bigint")
    return F.struct(
        prompt.alias("prompt_tokens"),
        F.array_max(lengths).cast("bigint").alias("longest_completion_tokens"),
        total.alias("completion_tokens"),
        (prompt + total).alias("total_tokens"),
    )


def candidates(texts: Column | str, lengths: Column | str | None = None, max_tokens=None) -> Column:
    """``[{message}]`` from generated texts; with token counts also ``metadata.finish_reason``."""
    if lengths is None:
        return F.transform(col(texts), lambda x: F.struct(_assistant(x).alias("message")))
    limit = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
    return F.zip_with(
        col(texts),
        col(lengths),
        lambda x, n: F.struct(
            _assistant(x).alias("message"),
            F.struct(finish_reason(n, limit).alias("finish_reason")).alias("metadata"),
        ),
    )


def candidates_response(
    texts: Column | str, lengths: Column | str, prompt_tokens: Column | str, max_tokens, model: str
) -> Column:
    """The record of a chat route: candidates and their metadata with true token counts."""
    counted = usage(prompt_tokens, lengths)
    return F.struct(
        candidates(texts, lengths, max_tokens).alias("candidates"),
        F.struct(
            counted["prompt_tokens"].alias("input_tokens"),
            counted["completion_tokens"].alias("output_tokens"),
            counted["total_tokens"].alias("total_tokens"),
            F.lit(model).alias("model"),
            F.lit(CHAT_ROUTE).alias("route_type"),
        ).alias("metadata"),
    )


def text_completion(
    request_id: Column | str,
    texts: Column | str,
    lengths: Column | str,
    prompt_tokens: Column | str,
    max_tokens,
    model: str,
) -> Column:
    """The record of a completion service with one choice per candidate."""
    limit = max_tokens if isinstance(max_tokens, Column) else F.lit(max_tokens)
    numbered = F.transform(col(texts), lambda x, i: F.struct(x.alias("text"), i.alias("index")))
    choices = F.zip_with(
        numbered,
        col(lengths),
        lambda c, n: F.struct(
            c["text"].alias("text"), c["index"].alias("index"), finish_reason(n, limit).alias("finish_reason")
        ),
    )
    return F.struct(
        col(request_id).cast("string").alias("request_id"),
        F.lit("text_completion").alias("object"),
        F.lit(model).alias("model"),
        choices.alias("choices"),
        usage(prompt_tokens, lengths).alias("usage"),
    )


def _assistant(text: Column, role: str = "assistant") -> Column:
    return F.struct(F.lit(role).alias("role"), text.alias("content"))


def completion(
    request_id: Column | str,
    created: Column,
    model: str,
    content: Column | str,
    reason: Column | str,
    prompt_tokens: Column | str,
    completion_tokens: Column | str,
) -> Column:
    """A chat completion record."""
    prompt, done = col(prompt_tokens).cast("bigint"), col(completion_tokens).cast("bigint")
    return F.struct(
        col(request_id).cast("string").alias("id"),
        F.lit("chat.completion").alias("object"),
        created.cast("bigint").alias("created"),
        F.lit(model).alias("model"),
        F.array(
            F.struct(
                F.lit(0).alias("index"),
                _assistant(col(content)).alias("message"),
                col(reason).alias("finish_reason"),
            )
        ).alias("choices"),
        F.struct(
            prompt.alias("prompt_tokens"),
            done.alias("completion_tokens"),
            (prompt + done).alias("total_tokens"),
        ).alias("usage"),
    ).cast(COMPLETION)


def policy_violation(explanation: Column | str) -> Column:
    """The record given back instead of an answer; ids and usage are null."""
    nothing = F.lit(None)
    return F.struct(
        nothing.alias("id"),
        nothing.alias("object"),
        nothing.alias("created"),
        nothing.alias("model"),
        F.array(
            F.struct(
                nothing.alias("index"),
                _assistant(col(explanation), "Assistant").alias("message"),
                F.lit(t.POLICY_VIOLATION).alias("finish_reason"),
            )
        ).alias("choices"),
        F.struct(
            nothing.alias("prompt_tokens"),
            nothing.alias("completion_tokens"),
            nothing.alias("total_tokens"),
        ).alias("usage"),
    ).cast(COMPLETION)
