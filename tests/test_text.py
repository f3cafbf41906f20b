import datetime
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from promptloom.functions import pii, text, tokens

PY_SPACES = [chr(c) for c in range(0x10000) if chr(c).isspace()]


def test_strip_is_pythons(column):
    inputs = [None, "", " a b ", " x\n", "\x1cx\x85", "".join(PY_SPACES) + "a" + "".join(PY_SPACES), "  "]
    assert column(text.strip, inputs) == [None if x is None else x.strip() for x in inputs]


def test_after_last(column):
    inputs = ["no mark", "[/INST] a", "x[/INST]b[/INST] c \n", "x[/INST]", "", None]
    assert column(text.after_last, inputs) == ["no mark", "a", "c", "", "", None]


def test_after_first(column):
    inputs = [" no mark ", "[/INST] at start", "q[/INST] a[/INST] b ", "q[/INST]x[inst}y", "[inst}", None]
    assert column(text.after_first, inputs) == [" no mark ", "[/INST] at start", "a[/INST] b", "xy", "", None]


def test_after_separator(column):
    assert column(text.after_separator, ["a[/INST]\nb[/INST]\nc", "a[/INST] b", ""]) == ["b", None, None]


def test_between(column):
    inputs = [
        "a ### Response: b ### End c",
        "### Response:\n b \n",
        "### End ### Response: x",
        "no start ### End",
        "### Response: a ### Response: b ### End ### End",
        "### Response:### End",
        None,
    ]
    assert column(text.between, inputs) == ["b", "b", "x", None, "a ### Response: b", "", None]


def test_colon_and_lines(column):
    assert column(text.after_colon, ["a: b: c", "a", ""]) == [" b", None, None]
    assert column(lambda x: text.after_colon(x, keep_rest=True), ["a: b: c"]) == [" b: c"]
    assert column(text.second_line, ["a\nb\nc", "a"]) == ["b", None]


def test_lists(column):
    assert column(text.list_items, ["", "1. shirt, 2) dress, , x", "10.- a,b"]) == [[], ["shirt", ") dress", "x"], ["a,b"]]
    assert column(text.first_line_items, ["\n1. casual,-formal, x \nmore"]) == [["casual", "-formal", " x"]]
    assert column(lambda x: text.longer_than(F.split(x, ",")), ["a,bb,,ccc"]) == [["bb", "ccc"]]


def test_collapse_is_one_pass(column):
    assert column(text.collapse_double_spaces, ["a  b   c"]) == ["a  b   c".replace("  ", " ")]


def test_stop_words(column):
    cut = lambda x: text.cut_at_stop(x, ["", "END", "\n"])
    assert column(cut, ["aENDb\nc", "a\nEND", "none", "ENDa", None]) == ["a", "a", "none", "", None]
    assert column(lambda x: text.cut_at_stop(x, []), ["abc"]) == ["abc"]
    per_row = lambda x: text.cut_at_stop(x, F.array(F.substring(x, 2, 1)))
    assert column(per_row, ["abc", "xyx"]) == ["a", "x"]


def test_drop_prompt(spark, column):
    assert column(lambda x: text.drop_prompt(x, F.lit("ab")), ["abc", "xabc", "ab"]) == ["c", "xabc", ""]
    ids = spark.sql("SELECT array(1,2,3) o, array(1,2) p UNION ALL SELECT array(1), array(1,2)")
    got = [r[0] for r in ids.select(text.drop_prompt_tokens("o", "p")).collect()]
    assert got == [[3], []]


def test_stamp_and_elapsed(spark):
    clock = F.lit(datetime.datetime(2024, 2, 3, 4, 5, 6))
    row = spark.range(1).select(text.stamped(F.lit("hi"), "bot", clock)).first()
    assert row[0] == "[03/02/2024 04:05:06] bot: hi"
    seconds = [0.0, 59.5, 3600.0, 86399.999, 86400.0, 200000.25]
    rows = spark.createDataFrame([(s,) for s in seconds], "s double").coalesce(1)
    got = [r[0] for r in rows.select(text.elapsed_text("s")).collect()]
    assert got == [str(datetime.timedelta(seconds=s)) for s in seconds]


def test_markup(column):
    page = "<!-- a > b --><style>p{}</style><p>x&amp;lt; y&nbsp;&lt;z</p>\n<script>if (a<b) {}</script><b>q</b>"
    assert column(text.strip_markup, [page, "", None]) == ["x&lt; y <z q", "", None]


def test_pii(column):
    inputs = [
        "mail a+b@x.example.com now",
        "card 4111 1111 1111 1111 next to +1 (555) 555-1234.",
        "see http://10.0.0.255/x and 300.1.1.1",
        "ssn 123-45-6789, iban DE89 3704 0044 0532 0130 00",
        "call 555-123-4567",
        "nothing here",
        None,
    ]
    assert column(pii.mask_pii, inputs) == [
        "mail <EMAIL_ADDRESS> now",
        "card <CREDIT_CARD> next to <PHONE_NUMBER>.",
        "see http://<IP_ADDRESS>/x and 300.1.1.1",
        "ssn <US_SSN>, iban <IBAN_CODE>",
        "call <PHONE_NUMBER>",
        "nothing here",
        None,
    ]
    only_mail = lambda x: pii.mask_pii(x, ["EMAIL_ADDRESS"])
    assert column(only_mail, ["a@b.co 10.0.0.1"]) == ["<EMAIL_ADDRESS> 10.0.0.1"]


def test_token_counts(column):
    assert column(tokens.n_tokens, ["", "a b, c!", "naïve 12x", None]) == [0, 5, 2, None]
    assert column(lambda x: tokens.n_tokens(x, 3), ["a b c d e"]) == [3]
    assert column(lambda x: tokens.n_tokens(x, None), ["a " * 3000]) == [3000]


def test_token_ids_are_stable(column):
    ids = column(lambda x: tokens.token_ids(tokens.tokens(x), 100), ["a b a"])[0]
    assert ids[0] == ids[2] and all(0 <= i < 100 for i in ids)


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00"), max_size=60))
def test_pieces_rebuild_the_text(spark, value):
    row = spark.createDataFrame([(value,)], "x string").select(tokens.pieces("x"), tokens.tokens("x")).first()
    assert "".join(row[0]) == value
    assert all(not re.search(r"[ \t\n]", t) for t in row[1])


def test_window_sizes_are_checked():
    with pytest.raises(ValueError):
        tokens.windows(F.array(), 10, 10)
