"""The text of web pages, by one scan over comments, tags, attributes, raw text and character references."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import col

# Elements whose content is no text, elements that stand in a line of text, and white space.
RAW_TEXT = ("script", "style", "noscript", "template", "iframe", "xmp", "noembed", "noframes")
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr".split()
)
_SPACE = re.compile(r"[\t-\r\x1c-\x20\x85\xa0  -     　]+")
#: One step of the scan, at a "<". A tag begins with a letter and ends at a ">" outside quoted values, or, where a
#: quote is never closed, at the first ">". A comment or section that is never closed goes to the end.
_STEP = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))
      | <!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)
      | <(?:[!?]|/(?![A-Za-z]))[^>]*(?:>|\Z)
      | <(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)
        (?: (?:[^>"'=]|=\s*"[^"]*"|=\s*'[^']*'|=(?!\s*["'])|["'])*> | [^>]*(?:>|\Z) )""",
    re.S | re.X,
)


def text_of(page: str, breaks: str = " ") -> str:
    """Plain text of a page, broken ones included; a "<" that begins no tag is text.

    Comments, declarations, tags and the content of scripts, styles and the like go; tags of a line of text leave
    nothing behind, all others ``breaks``. Named and numeric references are decoded last, so decoded text is
    never taken for markup. White space is one space, and none at the ends.
    """
    out, at = [], 0
    while True:
        begin = page.find("<", at)
        if begin < 0:
            break
        out.append(html.unescape(page[at:begin]))
        step = _STEP.match(page, begin)
        if step is None:
            out.append("<")
            at = begin + 1
            continue
        at = step.end()
        if step["cdata"] is not None:
            out.append(step["cdata"])
        name = (step["name"] or "").lower()
        if name and name not in INLINE:
            out.append(breaks)
        if name in RAW_TEXT and not step["end"] and not step[0].endswith("/>"):
            close = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(page, at)
            at = close.start() if close else len(page)
    out.append(html.unescape(page[at:]))
    return _SPACE.sub(" ", "".join(out)).strip(" ")


def page_text(c: Column | str) -> Column:
    """The text of pages in one vectorised pass; null stays null. ``text.strip_markup`` is the native form for plain pages."""

    @F.pandas_udf("string")
    def scan(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in pages:
            yield batch.map(text_of, na_action="ignore")

    return scan(col(c))
