"""Cleaning and cutting of generated text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, as a regex class and one by one.
WHITESPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]"
WHITESPACE_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The markers generations are cut at.
INST_END = "[/INST]"
STRAY_MARK = "[inst}"
RESPONSE_KEY = "### Response:"
END_KEY = "### End"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Unicode-aware strip; ``trim`` without characters would only remove spaces."""
    return F.btrim(col(c), F.lit(WHITESPACE_CHARS))


def after_last(c: Column | str, marker: str = INST_END) -> Column:
    """Text behind the last marker, stripped; the whole text where the marker is missing."""
    return strip(F.substring_index(col(c), marker, -1))


def after_first(c: Column | str, marker: str = INST_END, drop: str = STRAY_MARK) -> Column:
    """Text behind the first marker when that marker is not at the very start; then ``drop`` is removed."""
    text = col(c)
    at = F.instr(text, F.lit(marker))
    rest = strip(F.substring(text, at + F.lit(len(marker)), F.length(text)))
    return F.replace(F.when(at > 1, rest).otherwise(text), F.lit(drop), F.lit(""))


def piece(c: Column | str, separator: str, index: int, limit: int = -1) -> Column:
    """Piece ``index`` of a literal split; null where there are fewer pieces."""
    return F.get(F.split(col(c), "\\Q" + separator + "\\E", limit), F.lit(index))


def after_separator(c: Column | str, separator: str = INST_END + "\n") -> Column:
    """The second piece of a split on ``separator``; null (not an error) when the separator is missing."""
    return piece(c, separator, 1)


def after_colon(c: Column | str, keep_rest: bool = False) -> Column:
    """Text between the first and the second colon; ``keep_rest`` keeps everything behind the first."""
    return piece(c, ":", 1, 2 if keep_rest else -1)


def second_line(c: Column | str) -> Column:
    return piece(c, "\n", 1)


def between(c: Column | str, start: str = RESPONSE_KEY, end: str = END_KEY) -> Column:
    """Text behind the first ``start`` up to the next ``end``.

    Runs to the end of the text when ``end`` is missing and is null when ``start`` is missing.
    """
    text = col(c)
    at = F.instr(text, F.lit(start))
    tail = F.substring(text, at + F.lit(len(start)), F.length(text))
    stop = F.instr(tail, F.lit(end))
    return F.when(at > 0, strip(F.when(stop > 0, F.substring(tail, F.lit(1), stop - 1)).otherwise(tail)))


def _lstrip(c: Column, charset: str) -> Column:
    return F.ltrim(c, F.lit(charset))


def list_items(c: Column | str, charset: str = "0123456789.- ") -> Column:
    """``"1. shirt, 2. dress"`` to an array: split on comma-space, drop empties, strip numbering."""
    pieces = F.filter(F.split(col(c), ", ", -1), lambda x: x != "")
    return F.transform(pieces, lambda x: _lstrip(x, charset))


def first_line_items(
    c: Column | str, charset: str = "0123456789-. ", strip_spaces: bool = True
) -> Column:
    """Comma-separated items of the first non-empty line, numbering removed."""
    line = _lstrip(F.get(F.filter(F.split(col(c), "\n", -1), lambda x: x != ""), F.lit(0)), charset)
    return F.split(F.trim(line) if strip_spaces else line, ",", -1)


def longer_than(c: Column | str, n: int = 1) -> Column:
    """Array elements with more than ``n`` characters."""
    return F.filter(col(c), lambda x: F.length(x) > n)


def collapse_double_spaces(c: Column | str) -> Column:
    """One pass over pairs of spaces, as ``str.replace`` does (three spaces become two)."""
    return F.replace(col(c), F.lit("  "), F.lit(" "))


def cut_at_stop(c: Column | str, stops: Sequence[str] | Column) -> Column:
    """Text before the earliest stop sequence; unchanged when none occurs."""
    text = col(c)
    words = stops if isinstance(stops, Column) else F.array(*[F.lit(s) for s in stops]).cast("array<string>")
    hits = F.filter(
        F.transform(F.filter(words, lambda s: s != ""), lambda s: F.instr(text, s)), lambda p: p > 0
    )
    first = F.array_min(hits)
    return F.when(first.isNull(), text).otherwise(F.substring(text, F.lit(1), first - 1))


def drop_prompt(c: Column | str, prompt: Column | str) -> Column:
    """Remove the prompt a model echoed in front of its answer."""
    text, head = col(c), col(prompt)
    rest = F.substring(text, F.length(head) + 1, F.length(text))
    return F.when(F.startswith(text, head), rest).otherwise(text)


def drop_prompt_tokens(output_ids: Column | str, prompt_ids: Column | str) -> Column:
    """Output token array without its leading prompt tokens."""
    out, head = col(output_ids), col(prompt_ids)
    return F.slice(out, F.size(head) + 1, F.greatest(F.size(out), F.lit(1)))


def finish_reason(n_generated: Column | str, max_tokens: Column | str) -> Column:
    return F.when(col(n_generated) >= col(max_tokens), F.lit("length")).otherwise(F.lit("stop"))


def stamped(response: Column | str, name: str, now: Column | None = None) -> Column:
    """``[dd/mm/yyyy HH:MM:SS] name: response``; pass ``now`` to fix the clock."""
    clock = F.current_timestamp() if now is None else now
    return F.concat(
        F.lit("["), F.date_format(clock, "dd/MM/yyyy HH:mm:ss"), F.lit(f"] {name}: "), col(response)
    )


def elapsed_text(seconds: Column | str) -> Column:
    """Seconds as ``[N day(s), ]H:MM:SS[.ffffff]``, the way Python prints a timedelta."""
    micros = F.round(col(seconds) * F.lit(1_000_000)).cast("bigint")
    whole = F.floor(micros / 1_000_000)
    days = F.floor(whole / 86400)
    day_text = F.when(days == 0, "").otherwise(
        F.concat(days.cast("string"), F.when(days == 1, " day, ").otherwise(" days, "))
    )
    fraction = F.pmod(micros, F.lit(1_000_000))

    def two(c: Column) -> Column:
        return F.lpad(c.cast("string"), 2, "0")

    clock = F.concat(
        F.floor(F.pmod(whole, F.lit(86400)) / 3600).cast("string"),
        F.lit(":"),
        two(F.floor(F.pmod(whole, F.lit(3600)) / 60)),
        F.lit(":"),
        two(F.pmod(whole, F.lit(60))),
        F.when(fraction == 0, "").otherwise(F.concat(F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))),
    )
    return F.concat(day_text, clock)


def sha256_hex(c: Column | str) -> Column:
    return F.sha2(col(c), 256)


def file_name(id_col: Column | str, suffix: str = ".png") -> Column:
    return F.concat(col(id_col).cast("string"), F.lit(suffix))


# Markup that is removed, and the entities that are decoded (ampersand last).
_MARKUP = [r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script\s*>", r"(?is)<style\b.*?</style\s*>", r"(?s)<[^>]*>"]
_ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]


def strip_markup(c: Column | str) -> Column:
    """Plain text of an HTML page: comments, scripts, styles and tags out, entities decoded."""
    text = col(c)
    for pattern in _MARKUP:
        text = F.regexp_replace(text, pattern, " ")
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return strip(F.regexp_replace(text, rf"{WHITESPACE}+", " "))
