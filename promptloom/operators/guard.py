"""Guarding chats: verdicts, categories, and the safe chat."""

from __future__ import annotations

from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chat, moderation, pii, responses
from ..functions import templates as t
from ..functions import tokens
from ..functions.text import col
from ..session import materialize
from .generate import BATCH_SIZE, Loader, generate


def score(
    df: DataFrame,
    prompt: str | Column,
    loader: Loader,
    taxonomy: Column,
    batch_size: int = BATCH_SIZE,
    variant: str = "sentence",
    params: dict[str, Column] | None = None,
    n_partitions: int | None = None,
    profile: ResourceProfile | None = None,
) -> DataFrame:
    """Guard model plus its verdict taken apart.

    Adds ``verdict``, ``status``, ``error``, ``is_safe`` (null where the guard gave no verdict),
    ``code`` (the second line as it is), ``category`` (looked up by that line) and ``categories`` (one
    entry per code). The last two are null for safe rows. The taxonomy is parsed once per row.
    """
    judged = generate(df, prompt, "verdict", loader, batch_size, params, n_partitions=n_partitions, profile=profile)
    judged = judged.withColumn("is_safe", moderation.is_safe("verdict"))
    return _described(judged.withColumn("code", moderation.violation_code("verdict")), taxonomy, variant)


def _described(judged: DataFrame, taxonomy: Column, variant: str) -> DataFrame:
    entries = F.col("_entries")
    return (
        judged.withColumn("_entries", moderation.taxonomy_entries(taxonomy, variant))
        .withColumns(
            {
                "category": F.when(~F.col("is_safe"), moderation.description("code", entries)),
                "categories": F.when(~F.col("is_safe"), moderation.descriptions("code", entries)),
            }
        )
        .drop("_entries")
    )


def per_chat(parts: DataFrame, chat_id: str, taxonomy: Column, variant: str = "sentence") -> DataFrame:
    """Verdicts of the parts of chats combined: unsafe if any part is, not judged (null) if any part is not.

    The codes of several unsafe parts become one list without repeats, in the order O1, O2, …, O10.
    Plain aggregates, combined before the shuffle; the codes a group gathers are those of the taxonomy.
    """
    combined = parts.groupBy(chat_id).agg(
        F.max(~F.col("is_safe")).alias("unsafe"),
        F.max(F.col("is_safe").isNull()).alias("open"),
        F.collect_set("code").alias("codes"),
    )
    single = F.transform(F.flatten(F.transform("codes", lambda c: F.split(c, ","))), lambda c: F.trim(c))
    ordered = F.transform(
        F.array_sort(F.transform(F.array_distinct(single), lambda c: F.struct(F.length(c).alias("n"), c.alias("c")))),
        lambda s: s["c"],
    )
    code = F.when(F.size("codes") == 1, F.get("codes", F.lit(0))).when(F.size("codes") > 1, F.array_join(ordered, ","))
    verdict = F.when(F.coalesce("unsafe", F.lit(False)), False).when(~F.col("open"), True)
    return _described(combined.select(chat_id, verdict.alias("is_safe"), code.alias("code")), taxonomy, variant)


def safe_chat(
    requests: DataFrame,
    chat_loader: Loader,
    guard_loader: Loader,
    request_id: str,
    model_name: str,
    created: Column,
    batch_size: int = BATCH_SIZE,
    chat_endpoint: str = "chat",
    filter_endpoint: str = "guard",
) -> DataFrame:
    """Answer chats, guarding prompt and answer where the request asks for it.

    ``requests`` has ``messages`` and the optional settings ``enable_safety_filter``,
    ``enable_pii_filter``, ``unsafe_categories``, ``temperature``, ``max_tokens``,
    ``chat_endpoint`` and ``filter_endpoint``; missing or null settings take their defaults row by
    row. Both models are called with parameters and find their endpoint's name among them.
    Gives ``outcome``, the ``response`` record and the model's ``status``. Where the guard gave no
    verdict (out of memory) nothing passes: the outcome is ``not judged``, with the status, and no content.

    Which rows a model sees is decided by filters. Verdicts are written to the shared folder
    before the branches, so no row is judged twice or lands on both sides.
    """
    # The defaults of the chat service.
    defaults = {
        "enable_safety_filter": False,
        "enable_pii_filter": False,
        "unsafe_categories": t.DEFAULT_TAXONOMY,
        "temperature": 0.1,
        "max_tokens": 512,
        "chat_endpoint": chat_endpoint,
        "filter_endpoint": filter_endpoint,
    }
    asked = requests.select(
        request_id,
        "messages",
        *[
            (responses.defaulted(n, d) if n in requests.columns else F.lit(d)).alias(n)
            for n, d in defaults.items()
        ],
    )
    taxonomy = F.col("unsafe_categories")
    checked = asked.where("enable_safety_filter")
    # Null where the guard gave no verdict, which must not pass as safe.
    unsafe, judged_safe = ~F.col("is_safe"), F.coalesce(F.col("is_safe"), F.lit(False))

    guard_prompt = chat.moderation_prompt_whole_chat("messages", taxonomy)
    guard_params = {"endpoint": F.col("filter_endpoint")}

    def judge(df: DataFrame, prompt: Column) -> DataFrame:
        return score(df, prompt, guard_loader, taxonomy, batch_size, params=guard_params)

    judged = materialize(judge(checked, guard_prompt))
    blocked = judged.where(~judged_safe).select(
        *asked.columns,
        F.when(unsafe, "prompt blocked").otherwise("not judged").alias("outcome"),
        F.when(unsafe, moderation.prompt_violation("category")).alias("answer"),
        F.lit(None).cast("string").alias("reason"),
        "status",
    )
    passed = judged.where(judged_safe).select(*asked.columns)

    params = {
        "temperature": F.col("temperature"),
        "max_tokens": F.col("max_tokens"),
        "endpoint": F.col("chat_endpoint"),
    }

    def answer(df: DataFrame) -> DataFrame:
        prompt = F.to_json("messages", {"ignoreNullFields": "false"})
        return generate(df, prompt, "answer", chat_loader, batch_size, params)

    answered = answer(passed).drop("error").withColumnRenamed("status", "answer_status")
    whole = chat.append_assistant("messages", "answer")
    rejudged = judge(answered, chat.moderation_prompt_whole_chat(whole, taxonomy))
    n_answer = tokens.n_tokens("answer", None)
    reason = F.when(n_answer >= F.col("max_tokens"), "length").otherwise("stop")
    guarded = rejudged.select(
        *asked.columns,
        F.when(F.col("answer").isNull(), "failed")
        .when(unsafe, "answer blocked")
        .when(judged_safe, "answered")
        .otherwise("not judged")
        .alias("outcome"),
        F.when(F.col("answer").isNull() | judged_safe, F.col("answer"))
        .when(unsafe, moderation.response_violation("category"))
        .alias("answer"),
        F.when(judged_safe, reason).alias("reason"),
        F.when(F.col("answer").isNull(), F.col("answer_status")).otherwise(F.col("status")).alias("status"),
    )
    free = answer(asked.where(~F.col("enable_safety_filter"))).select(
        *asked.columns,
        F.when(F.col("answer").isNull(), "failed").otherwise("answered").alias("outcome"),
        "answer",
        reason.alias("reason"),
        "status",
    )
    everything = blocked.unionByName(guarded).unionByName(free)

    shown = F.when(F.col("enable_pii_filter"), pii.mask_pii("answer")).otherwise(F.col("answer"))
    record = responses.completion(
        request_id,
        created,
        model_name,
        shown,
        "reason",
        tokens.n_tokens(F.to_json("messages"), None),
        n_answer,
    )
    return everything.select(
        request_id,
        "outcome",
        F.when(F.col("outcome").endswith("blocked"), responses.policy_violation("answer"))
        .otherwise(record)
        .alias("response"),
        "status",
    )


def answer_text(response: Column | str) -> Column:
    """Text of the first choice of a completion record."""
    return F.get(col(response)["choices"], F.lit(0))["message"]["content"]
