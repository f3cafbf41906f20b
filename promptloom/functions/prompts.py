"""Prompt rendering as native string concatenation.

Field values are data: braces inside them are never read as fields. A null field gives a null
prompt (never the word "None").
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import templates as t
from .text import col, collapse_double_spaces, strip


def render(template: str, **fields: Column | str) -> Column:
    """Concatenate a template; it is taken apart once on the driver.

    Column objects are used as they are and plain strings are literal text.
    """
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            if name not in fields:
                raise ValueError(f"template field {name!r} has no value")
            value = fields[name]
            parts.append(value if isinstance(value, Column) else F.lit(value))
    return F.concat(*parts) if parts else F.lit("")


def _present(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def summary(text: Column | str, system: str = t.CONCISE_SYSTEM_PROMPT) -> Column:
    return render(t.SUMMARY, system=system, text=col(text))


def single_turn(
    instruction: Column | str, system: str = t.DEFAULT_SYSTEM_PROMPT, form: str = "standard"
) -> Column:
    """``form`` is ``standard``, ``spaced`` or ``compact``."""
    template = {
        "standard": t.SINGLE_TURN,
        "spaced": t.SINGLE_TURN_SPACED,
        "compact": t.SINGLE_TURN_COMPACT,
    }[form]
    return render(template, system=system, instruction=col(instruction))


def _with_or_without_input(
    plain: str, with_input: str, context: Column | str | None, **fields: Column | str
) -> Column:
    without = render(plain, intro=t.INTRO, **fields)
    if context is None:
        return without
    context = col(context)
    return F.when(_present(context), render(with_input, intro=t.INTRO, context=context, **fields)).otherwise(
        without
    )


def training_text(
    instruction: Column | str, response: Column | str, context: Column | str | None = None
) -> Column:
    """Instruction, optional input block, response and end mark. Empty context counts as absent."""
    return _with_or_without_input(
        t.TRAINING, t.TRAINING_INPUT, context, instruction=col(instruction), response=col(response)
    )


def prompt_only(instruction: Column | str, context: Column | str | None = None) -> Column:
    return _with_or_without_input(t.PROMPT_ONLY, t.PROMPT_ONLY_INPUT, context, instruction=col(instruction))


def pair_text(
    instruction: Column | str, response: Column | str, context: Column | str | None = None
) -> Column:
    """``{ 'prompt': …, 'response': … }`` as plain text, neither JSON nor escaped."""
    return render(t.PAIR_TEXT, prompt=prompt_only(instruction, context), response=col(response))


def compact_text(
    instruction: Column | str, response: Column | str, context: Column | str | None = None
) -> Column:
    head = _with_or_without_input(t.COMPACT, t.COMPACT_INPUT, context, instruction=col(instruction))
    return F.concat(head, F.lit("\n"), col(response))


def inference_prompt(instruction: Column | str, indent: int = 8, blank_lines: bool = False) -> Column:
    """Instruction prompt whose lines behind the first are indented, blank lines between on request."""
    pad, gap = " " * indent, "\n\n" if blank_lines else "\n"
    template = f"{{intro}}{gap}{pad}### Instruction:\n{pad}{{instruction}}{gap}{pad}### Response:\n{pad}"
    return render(template, intro=t.INTRO, instruction=col(instruction))


def hash_instruction(instruction: Column | str) -> Column:
    return render(t.HASH_INSTRUCTION, intro=t.INTRO, instruction=col(instruction))


def dataset_prompt(instruction: Column | str) -> Column:
    return render(t.DATASET_PROMPT, intro=t.INTRO, instruction=col(instruction))


def dataset_response(response: Column | str) -> Column:
    return F.concat(col(response), F.lit(t.END_OF_RESPONSE))


def schema_text(context: Column | str) -> Column:
    """Table definitions as the SQL instruction wants them: no CREATE TABLE, VARCHAR as STRING."""
    bare = F.replace(col(context), F.lit("CREATE TABLE"), F.lit(""))
    return strip(F.replace(bare, F.lit("VARCHAR"), F.lit("STRING")))


def sql_instruction(question: Column | str, context: Column | str) -> Column:
    return render(t.SQL_INSTRUCTION, question=col(question), schema=schema_text(context))


def prompt_and_response(prompt: Column | str, response: Column | str) -> Column:
    return F.concat(col(prompt), col(response))


def entity_extraction(text: Column | str) -> Column:
    return render(t.ENTITY_EXTRACTION, text=col(text))


def code_task(text: Column | str) -> Column:
    return render(t.CODE_TASK, text=col(text))


def with_context(template: str, context: Column | str, question: Column | str) -> Column:
    """Retrieval prompt from a user template with ``{context}`` and ``{question}``."""
    return render(template, context=col(context), question=col(question))


def _prefixed(c: Column | str, mark: str) -> Column:
    text = col(c)
    return F.when(F.startswith(text, F.lit(mark)), text).otherwise(F.concat(F.lit(mark + " "), text))


def passage(c: Column | str) -> Column:
    """Add ``passage: `` unless it is there already."""
    return _prefixed(c, t.PASSAGE)


def query(c: Column | str) -> Column:
    """Add ``query: `` unless it is there already."""
    return _prefixed(c, t.QUERY)


def bge_query(c: Column | str, language: str | None = "en") -> Column:
    """Query instruction of the retrieval models; ``None`` for models that take the bare query."""
    return col(c) if language is None else F.concat(F.lit(t.BGE_QUERY[language]), col(c))


def instructor(
    text_type: Column | str,
    domain: Column | str | None = None,
    task_objective: Column | str | None = None,
) -> Column:
    """``Represent the {domain} {text_type} for {task_objective}:``; null parts are left out."""
    parts = [F.lit("Represent the")]
    if domain is not None:
        parts.append(col(domain))
    parts.append(col(text_type))
    if task_objective is not None:
        parts.append(F.concat(F.lit("for "), col(task_objective)))
    return F.concat(F.concat_ws(" ", *parts), F.lit(":"))


def description(colour: Column | str, style: Column | str, item: Column | str) -> Column:
    return collapse_double_spaces(
        render(t.DESCRIPTION, colour=col(colour), style=col(style), item=col(item))
    )


def caption(colour: Column | str, style: Column | str, item: Column | str) -> Column:
    return collapse_double_spaces(render(t.CAPTION, colour=col(colour), style=col(style), item=col(item)))


def decorated(prompt: Column | str, style: str, system: str = t.DEFAULT_SYSTEM_PROMPT) -> Column:
    """``style``: ``step_inst``, ``step_chat``, ``concise`` or ``system``."""
    if style == "system":
        return render(t.SYSTEM_INSTRUCTION, system=system, prompt=col(prompt))
    template = {
        "step_inst": t.STEP_BY_STEP_INST,
        "step_chat": t.STEP_BY_STEP_CHAT,
        "concise": t.CONCISE,
    }[style]
    return render(template, prompt=col(prompt))
