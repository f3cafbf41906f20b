"""One row per chat from one row per turn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import chat as c

#: Turns that one guard prompt shows.
TURNS_PER_PROMPT = 1024


def _message(role: str, content: str) -> Column:
    return F.struct(F.col(role).alias("role"), F.col(content).alias("content"))


def assemble_chats(
    turns: DataFrame, chat_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """One row per chat with its ``messages`` in the order of ``turn``, which may have gaps.

    For what is one value per chat, such as its prompt; so a chat has to fit in a row. ``chat_facts`` and
    ``chat_parts`` take chats of any length apart instead. Turns are read and shuffled once.
    """
    entry = F.struct(F.col(turn).alias("turn"), _message(role, content).alias("m"))
    return (
        turns.groupBy(chat_id)
        .agg(F.array_sort(F.collect_list(entry)).alias("_e"))
        .select(chat_id, F.transform("_e", lambda e: e["m"]).alias("messages"))
        .withColumns(
            {
                "n_turns": F.size("messages"),
                "has_system": c.starts_with_system("messages"),
                "problem": c.chat_problem("messages"),
            }
        )
    )


def _numbered(turns: DataFrame, chat_id: str, turn: str, *more: str) -> DataFrame:
    """``position`` of every turn in its chat, from 0 without gaps. Sorts by chat; a long one spills."""
    order = Window.partitionBy(chat_id).orderBy(turn, *more)
    return turns.withColumn("position", F.row_number().over(order) - 1)


def chat_facts(
    turns: DataFrame, chat_id: str = "conv_id", turn: str = "turn", role: str = "role"
) -> DataFrame:
    """``n_turns, has_system, problem, last_role`` of every chat, by plain aggregates: no array of turns is built."""
    numbered = _numbered(turns.select(chat_id, turn, role), chat_id, turn, role)
    at, who = F.col("position"), F.col(role)

    def wrong(position: Column) -> Column:
        expected = F.when(F.pmod(position, F.lit(2)) == 0, "user").otherwise("assistant")
        return F.sum((~who.eqNullSafe(expected)).cast("bigint"))

    facts = numbered.groupBy(chat_id).agg(
        F.count(F.lit(1)).alias("n_turns"),
        F.coalesce(F.max((at == 0) & (who == "system")), F.lit(False)).alias("has_system"),
        wrong(at).alias("wrong"),
        # Shifted by the system message, which itself is no user's or assistant's.
        wrong(at - 1).alias("wrong_shifted"),
        F.max_by(who, at).alias("last_role"),
    )
    n_wrong = F.when(F.col("has_system"), F.col("wrong_shifted") - 1).otherwise(F.col("wrong"))
    empty = F.col("n_turns") == F.col("has_system").cast("int")
    problem = (
        F.when(empty, c.EMPTY)
        .when(n_wrong > 0, c.NOT_ALTERNATING)
        .when(~F.col("last_role").eqNullSafe(F.lit("user")), c.NOT_USER_LAST)
    )
    return facts.select(chat_id, "n_turns", "has_system", problem.alias("problem"), "last_role")


def chat_prompts(chats: DataFrame, **options) -> DataFrame:
    """Multi-turn prompts of the assembled chats without a problem."""
    return chats.where(F.col("problem").isNull()).withColumn("prompt", c.chat_prompt("messages", **options))


def moderation_prompts(chats: DataFrame, taxonomy: Column | str) -> DataFrame:
    """One guard prompt for each assembled chat, valid or not."""
    return chats.withColumn("prompt", c.moderation_prompt("messages", taxonomy))


def guard_parts(
    turns: DataFrame,
    taxonomy: Column | str,
    chat_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    content: str = "text",
    turns_per_prompt: int = TURNS_PER_PROMPT,
) -> DataFrame:
    """``chat, part, prompt``: guard prompts of at most ``turns_per_prompt`` turns each.

    Every part has the whole head, taxonomy and tail, so it is judged by the same rules as a chat of its
    own; ``guard.per_chat`` combines the verdicts. No group grows beyond a part.
    """
    numbered = _numbered(turns.select(chat_id, turn, role, content), chat_id, turn, role, content)
    counted = numbered.withColumn("n_turns", F.count(F.lit(1)).over(Window.partitionBy(chat_id)))
    entry = F.struct("position", _message(role, content).alias("m"))
    parts = (
        counted.groupBy(chat_id, "n_turns", F.floor(F.col("position") / turns_per_prompt).cast("int").alias("part"))
        .agg(F.array_sort(F.collect_list(entry)).alias("_e"))
        .withColumn("messages", F.transform("_e", lambda e: e["m"]))
    )
    prompt = c.moderation_prompt(
        "messages", taxonomy, n_messages=F.col("n_turns"), first_position=F.col("part") * turns_per_prompt
    )
    return parts.select(chat_id, "part", prompt.alias("prompt"))


def first_and_answers(
    turns: DataFrame, chat_id: str = "conv_id", turn: str = "turn", role: str = "role", content: str = "text"
) -> DataFrame:
    """``chat, query, positive``: the first user turn of a chat beside each assistant turn.

    A join of one row per chat with the assistant turns, so a chat of any length is spread by rows.
    Chats without a user turn have a null query.
    """
    first = turns.where(F.col(role) == "user").groupBy(chat_id).agg(F.min_by(content, turn).alias("query"))
    answers = turns.where(F.col(role) == "assistant").select(chat_id, F.col(content).alias("positive"))
    return answers.join(first, chat_id, "left").select(chat_id, "query", "positive")
