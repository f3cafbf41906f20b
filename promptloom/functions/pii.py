"""Masking of personal data that has a recognisable written form."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

# Entity name and pattern. The order matters: a loose phone pattern would also hit
# addresses and card numbers, so those are masked before it.
EMAIL = ("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = [
    ("IP_ADDRESS", r"\b(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\b"),
    ("IBAN_CODE", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("CREDIT_CARD", r"\b[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}\b"),
    ("US_SSN", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"),
    ("PHONE_NUMBER", r"(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}\b"),
    ("PHONE_NUMBER", r"\b[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}\b"),
]


def mask_pii(c: Column | str, entities: Sequence[str] | None = None) -> Column:
    """Replace each entity by ``<ENTITY>``; ``entities`` limits which kinds are masked.

    Most texts hold neither an at-sign nor a digit: two cheap tests spare them the patterns.
    """
    text = col(c)
    masked = text
    if entities is None or EMAIL[0] in entities:
        masked = F.when(text.contains("@"), _masked(text, EMAIL)).otherwise(text)
    numbers = masked
    for rule in NUMBERS:
        if entities is None or rule[0] in entities:
            numbers = _masked(numbers, rule)
    return F.when(text.rlike("[0-9]"), numbers).otherwise(masked)


def _masked(text: Column, rule: tuple[str, str]) -> Column:
    name, pattern = rule
    return F.regexp_replace(text, pattern, f"<{name}>")
