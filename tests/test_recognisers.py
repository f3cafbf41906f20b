"""Recognised entities: tests of numbers, spans, overlaps, masks."""

import random

import pytest
from pyspark.sql import functions as F

from promptloom.functions import recognisers as r


def luhn(digits):
    return sum(d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_luhn_and_mod_97(column):
    rng = random.Random(1)
    numbers = ["".join(rng.choice("0123456789") for _ in range(rng.randint(13, 19))) for _ in range(300)]
    assert column(r.luhn, numbers) == [luhn(n) for n in numbers]
    assert column(r.luhn, ["4111 1111-1111 1111", "4111 1111 1111 1112"]) == [True, False]
    ibans = ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606", "DE88 3704 0044 0532 0130 00", "NO9386011117947"]
    assert column(r.mod_97, ibans) == [True, True, True, False, True]


CASES = {
    "mail a+b@x.example.com now": "mail <EMAIL_ADDRESS> now",
    "card 4111 1111 1111 1111 next to +1 (555) 555-1234.": "card <CREDIT_CARD> next to <PHONE_NUMBER>.",
    "order 4111 1111 1111 1112 is no card": "order 4111 1111 1111 1112 is no card",
    "AB12 CODE 1234 ORDER stays": "AB12 CODE 1234 ORDER stays",
    "AB12 CODE 4111 1111 1111 1111 X": "AB12 CODE <CREDIT_CARD> X",
    "iban DE89 3704 0044 0532 0130 00 PAID": "iban <IBAN_CODE> PAID",
    "see http://10.0.0.255/x and 300.1.1.1": "see http://<IP_ADDRESS>/x and 300.1.1.1",
    "ssn 123-45-6789 but not 000-45-6789 or 666-12-1234": "ssn <US_SSN> but not 000-45-6789 or 666-12-1234",
    "call 555-123-4567, or 555-123-4567": "call <PHONE_NUMBER>, or <PHONE_NUMBER>",
    "mail 10.0.0.1@x.org": "mail <EMAIL_ADDRESS>",
    "private  mark a@b.co": "private  mark <EMAIL_ADDRESS>",
    "nothing here": "nothing here",
    "": "",
    None: None,
}


def test_masks(column):
    assert column(r.mask_entities, list(CASES)) == list(CASES.values())
    assert column(lambda c: r.mask_entities(c, ["EMAIL_ADDRESS"]), ["a@b.co 10.0.0.1"]) == ["<EMAIL_ADDRESS> 10.0.0.1"]
    # Without a word that speaks for it, an address is under a higher bound.
    assert column(lambda c: r.mask_entities(c, ["IP_ADDRESS"], 0.8), ["see 10.0.0.1", "server ip 10.0.0.1"]) == ["see 10.0.0.1", "server ip <IP_ADDRESS>"]


@pytest.mark.parametrize("n", [0, 1, 40])
def test_spans_are_ordered_and_apart(spark, n):
    parts = ["a@b.co", "4111111111111111", "DE89370400440532013000", "10.1.2.3", "word", "(555) 555-1234", "é\U0001f600"]
    rng = random.Random(n)
    chosen = [rng.choice(parts) for _ in range(n)]
    text = " ".join(chosen)
    found = spark.createDataFrame([(text,)], "t string").select(r.find_entities("t").alias("s")).first()["s"]
    ends = [(x["start"], x["end"]) for x in found]
    assert all(a[1] <= b[0] for a, b in zip(ends, ends[1:]))
    assert [text[a:b] for a, b in ends] == [p for p in chosen if p not in ("word", parts[-1])]


def test_no_python_in_the_plan(spark):
    plan = spark.range(3).select(r.mask_entities(F.col("id").cast("string")).alias("m"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_text_is_searched_once(spark):
    """Each recogniser cuts the text once, and the text, itself the result of work, is computed once."""
    text = F.concat(F.col("id").cast("string"), F.lit(" once only"))
    found = spark.range(3).select(r.find_entities(text, ["EMAIL_ADDRESS", "CREDIT_CARD"]).alias("s"))
    plan = found._jdf.queryExecution().analyzed().toString()
    assert plan.count("once only") == 1 and plan.count("a-z0-9._%+-]+@") <= 1 and plan.count("[0-9]{13,19}") == 1
    assert [x["s"] for x in found.collect()] == [[]] * 3
