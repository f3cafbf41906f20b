"""Reading guard verdicts and safety taxonomies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import templates as t
from .prompts import render
from .text import WHITESPACE, col, strip

# How categories are written in a taxonomy, in two variants.
#   whole block: a code, then everything up to the next code line or the end of the text
#   sentence:    a code, then the text up to the first . ! or ?
WHOLE_BLOCK = r"(O\d+): ([\s\S]*?)(?=\nO\d+:|\z)"
SENTENCE = r"(O\d+): ([^.!?]*[.!?])"
SENTENCE_END = rf"(?<=[.!?]){WHITESPACE}+"

# The two wordings of a violation message.
VIOLATION = {
    "sentence": "{subject} classified as {category}. Fails safety measures.",
    "clause": "{subject} classified as {category}; fails safety measures.",
}


def is_safe(verdict: Column | str) -> Column:
    """First line of the verdict reads ``safe``, in any case."""
    return F.lower(F.get(F.split(strip(verdict), "\n", -1), F.lit(0))) == "safe"


def violation_code(verdict: Column | str) -> Column:
    """Second line of the verdict; null when there is only one."""
    return strip(F.get(F.split(strip(verdict), "\n", -1), F.lit(1)))


def taxonomy_entries(taxonomy: Column | str, variant: str = "block") -> Column:
    """``array<struct<code, description>>`` of a taxonomy text.

    ``block`` keeps the first sentence of each block even when it has no end mark; ``sentence``
    loses a category whose text never reaches . ! or ?.
    """
    text = col(taxonomy)
    pattern = WHOLE_BLOCK if variant == "block" else SENTENCE
    codes = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    bodies = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), strip)
    if variant == "block":
        bodies = F.transform(bodies, lambda b: F.get(F.split(b, SENTENCE_END, 2), F.lit(0)))
    return F.zip_with(codes, bodies, lambda c, d: F.struct(c.alias("code"), d.alias("description")))


def description(code: Column | str, entries: Column) -> Column:
    """Description for a code among parsed entries; a fixed text for codes outside them (later entries win)."""
    hits = F.filter(entries, lambda e: e["code"] == col(code))
    return F.coalesce(F.try_element_at(hits, F.lit(-1))["description"], F.lit(t.UNKNOWN_CATEGORY))


def descriptions(codes: Column | str, entries: Column) -> Column:
    """One description per code of a comma-separated list."""
    return F.transform(F.transform(F.split(col(codes), ",", -1), strip), lambda c: description(c, entries))


def category(code: Column | str, taxonomy: Column, variant: str = "block") -> Column:
    """Description for a code. A constant taxonomy folds to a constant array, so no join is needed."""
    return description(code, taxonomy_entries(taxonomy, variant))


def categories(code: Column | str, taxonomy: Column, variant: str = "block") -> Column:
    """One description per code of a comma-separated list."""
    return descriptions(code, taxonomy_entries(taxonomy, variant))


def prompt_violation(category_text: Column | str, wording: str = "sentence") -> Column:
    """Message for a blocked prompt, in one of the two wordings in use."""
    return render(VIOLATION[wording], subject="User's prompt", category=col(category_text))


def response_violation(category_text: Column | str, wording: str = "sentence") -> Column:
    """Message for a blocked answer, in one of the two wordings in use."""
    return render(VIOLATION[wording], subject="Model's response", category=col(category_text))
