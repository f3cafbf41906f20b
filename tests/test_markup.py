"""The scanner of pages: plain, odd and broken ones."""

import time

from hypothesis import given, settings
from hypothesis import strategies as st

from promptloom.operators.markup import page_text, text_of

CASES = {
    "": "",
    "plain text": "plain text",
    "<p>one</p><p>two</p>": "one two",
    "a<b>bold</b>c <i>it</i>": "aboldc it",
    "1 < 2 and 3 > 2": "1 < 2 and 3 > 2",
    "x <3 y <- z": "x <3 y <- z",
    "it&#8217;s &#x2014; &eacute;&nbsp;&amp;lt; &lt;b&gt;": "it’s — é &lt; <b>",
    "&unknown; & &#0; &copy 2024": "&unknown; & � © 2024",
    "<a href=\"x>y\" title='<p>'>link</a>!": "link!",
    "<img alt=\"never closed><p>after</p>": "after",
    "a<!-- <p>no</p> -->b<!---->c<!-->d": "abcd",
    "before<!-- never closed <p>x": "before",
    "<script>if (a < b) { x = '</p>' }</script>text": "text",
    "<SCRIPT type='x'>var a = \"<script>\";</SCRIPT >text": "text",
    "<style>p { } </style><noscript>no</noscript><p>yes": "yes",
    "<script>never closed <p>x</p>": "",
    "<scripture>kept</scripture>": "kept",
    "<!DOCTYPE html><?xml version='1.0'?><html><body>t</body></html>": "t",
    "<![CDATA[raw <b> & text]]>!": "raw <b> & text!",
    "</ bad><//x>ok": "ok",
    "tag at the end <p": "tag at the end",
    "a \n\t b c": "a b c",
    "<br/>x<br>y<hr>z": "x y z",
}


def test_cases():
    assert {page: text_of(page) for page in CASES} == CASES


def test_column(column):
    assert column(page_text, ["<p>x &amp; y</p>", "", None]) == ["x & y", "", None]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="<>!-/abps=\"'& ;#x1\n[]?", max_size=80))
def test_any_text(page):
    """Nothing breaks the scan, and text without markup signs stays as it is."""
    text = text_of(page)
    assert text == text.strip(" ") and "  " not in text
    if "<" not in page and "&" not in page:
        assert text == " ".join(page.split())


def test_long_pages_take_linear_time():
    for part in ("<", "<p ", "<a href='", "<!--", "<![CDATA[", "<script>", "&", "</", "<p a=\"b' "):
        began = time.perf_counter()
        text_of(part * 20_000)
        assert time.perf_counter() - began < 20, part
