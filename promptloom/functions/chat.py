"""Chats as arrays of ``{role, content}``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import templates as t
from .prompts import render
from .text import col
from ..schemas import MESSAGES


def parse_messages(json_text: Column | str) -> Column:
    """Chat given as a JSON string; null when it is not one."""
    return F.from_json(col(json_text), MESSAGES)


def message(role: str, content: Column | str) -> Column:
    return F.struct(F.lit(role).alias("role"), col(content).alias("content"))


def with_system(prompt: Column | str, system: str = t.ASSISTANT_SYSTEM_PROMPT) -> Column:
    """A bare prompt as a two-message chat."""
    return F.array(message("system", F.lit(system)), message("user", prompt))


def append_assistant(messages: Column | str, content: Column | str) -> Column:
    return F.array_append(col(messages), message("assistant", content))


def starts_with_system(messages: Column | str) -> Column:
    return F.coalesce(F.get(col(messages), F.lit(0))["role"] == "system", F.lit(False))


def without_system(messages: Column | str) -> Column:
    m = col(messages)
    return F.when(starts_with_system(m), F.slice(m, F.lit(2), F.size(m))).otherwise(m)


def every_other(messages: Column | str, start: int) -> Column:
    """Messages at positions start, start + 2, … (``start`` 0 or 1)."""
    return F.filter(col(messages), lambda m, i: i % 2 == start)


def last_role(messages: Column | str) -> Column:
    return F.try_element_at(col(messages), F.lit(-1))["role"]


def wrong_roles(messages: Column | str) -> Column:
    """How many messages break the user/assistant alternation."""

    def expected(i: Column) -> Column:
        return F.when(F.pmod(i, F.lit(2)) == 0, "user").otherwise("assistant")

    return F.size(F.filter(col(messages), lambda m, i: ~m["role"].eqNullSafe(expected(i))))


# Reasons a chat cannot be rendered, in the order they are tested.
EMPTY, NOT_ALTERNATING, NOT_USER_LAST = "empty", "roles do not alternate", "last message is not from user"


def chat_problem(messages: Column | str) -> Column:
    """Null for a valid chat: optional system first, then user/assistant in turn, user last."""
    turns = without_system(messages)
    return (
        F.when(col(messages).isNull() | (F.size(turns) == 0), EMPTY)
        .when(wrong_roles(turns) > 0, NOT_ALTERNATING)
        .when(~last_role(turns).eqNullSafe(F.lit("user")), NOT_USER_LAST)
    )


def render_turns(messages: Column | str) -> Column:
    """User messages inside instruction marks, other messages as they are."""
    return F.concat_ws(
        "",
        F.transform(
            col(messages),
            lambda m: F.when(
                m["role"] == "user", F.concat(F.lit(t.TURN_START), m["content"], F.lit(t.TURN_END))
            ).otherwise(m["content"]),
        ),
    )


def chat_prompt(messages: Column | str, default_system: str = t.CHAT_SYSTEM_PROMPT) -> Column:
    """Multi-turn prompt."""
    m = col(messages)
    system = F.when(starts_with_system(m), F.get(m, F.lit(0))["content"]).otherwise(F.lit(default_system))
    return F.concat(
        F.lit(t.SEQUENCE_START + t.SYSTEM_START), system, F.lit(t.SYSTEM_END), render_turns(without_system(m))
    )


def speaker(position: Column) -> Column:
    return F.when(F.pmod(position, F.lit(2)) == 0, "User").otherwise("Agent")


def moderation_prompt(
    messages: Column | str,
    taxonomy: Column | str = t.DEFAULT_TAXONOMY,
    n_messages: Column | None = None,
    first_position: Column | None = None,
) -> Column:
    """Prompt that judges the last speaker of a chat; speakers alternate by position.

    For a part of a chat, ``n_messages`` is the length of the whole chat and ``first_position`` where
    the part starts. A plain string ``taxonomy`` is the text itself.
    """
    m = col(messages)
    start = F.lit(0) if first_position is None else first_position
    total = F.size(m) if n_messages is None else n_messages
    judged = F.when(F.pmod(total, F.lit(2)) == 0, "Agent").otherwise("User")
    body = F.concat_ws(
        "",
        F.transform(
            m, lambda x, i: F.concat(speaker(i + start), F.lit(": "), x["content"], F.lit("\n\n"))
        ),
    )
    head = render(t.MODERATION_HEAD, role=judged, taxonomy=taxonomy)
    return F.concat(head, body, render(t.MODERATION_TAIL, role=judged))


def moderation_prompt_whole_chat(
    messages: Column | str, taxonomy: Column | str = t.DEFAULT_TAXONOMY
) -> Column:
    """Prompt that always judges the agent, with the chat as JSON in the middle."""
    chat = F.to_json(col(messages), {"ignoreNullFields": "false"})
    return render(t.MODERATION_WHOLE_CHAT, taxonomy=taxonomy, chat=chat)
