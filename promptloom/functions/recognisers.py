"""Entities with a written form: candidate spans, checked by their own rules, overlaps resolved, then masked.

``pii.mask_pii`` masks whatever looks right; here a card must pass the Luhn test and an IBAN its country's length
and the test modulo 97, a candidate's score rises with words before it that speak for it, and of overlapping
spans the best one stays. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import pii
from .text import col

SPANS = "array<struct<start:int,end:int,entity:string,score:double>>"
#: Characters before a candidate in which context words count, and what they add to the score.
CONTEXT, CONTEXT_BONUS = 40, 0.35
MIN_SCORE = 0.4
#: Stands around candidates while a text is cut; one in the text itself is taken for another private character.
_MARK, _OTHER = "", ""

# Lengths of IBANs by country.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 "
    "FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 "
    "MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 "
    "SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
)


@dataclass(frozen=True)
class Recogniser:
    """A pattern of candidates, a test of a candidate's text, a score, and words that speak for it."""

    entity: str
    pattern: str
    score: float
    valid: object = None
    context: tuple[str, ...] = ()
    cut: object = None
    #: A character that every candidate has; texts without it are not searched.
    needs: str = "[0-9]"


def luhn(candidate: Column) -> Column:
    """Whether the digits of a text pass the Luhn test: every second one from the right doubled, sum divisible by 10."""
    digits = F.transform(F.split(F.reverse(F.regexp_replace(candidate, "[^0-9]", "")), ""), lambda d: d.cast("int"))
    values = F.transform(digits, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(values, F.lit(0), lambda s, d: s + d) % 10 == 0


def iban_text(candidate: Column) -> Column:
    """The leading part of a candidate that is as long as its country's IBANs, or null; it may be cut inside."""
    lengths = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.split() for x in (pair[:2], int(pair[2:]))))
    wanted = F.get(F.array(lengths[F.substring(candidate, 1, 2)]), F.lit(0))
    marks = F.split(candidate, "")
    seen = F.transform(marks, lambda _, i: F.size(F.filter(F.slice(marks, 1, i + 1), lambda c: c != " ")))
    return F.when(
        F.length(F.replace(candidate, F.lit(" "))) >= wanted, F.array_join(F.slice(marks, F.lit(1), F.array_position(seen, wanted).cast("int")), "")
    )


def mod_97(candidate: Column) -> Column:
    """Whether an IBAN's number, country and check digits moved to its end, leaves 1 modulo 97."""
    plain = F.replace(candidate, F.lit(" "))
    moved = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))
    numbers = F.transform(F.split(moved, ""), lambda c: F.when(c >= "A", F.ascii(c) - 55).otherwise(F.ascii(c) - 48))
    return F.aggregate(numbers, F.lit(0), lambda r, n: F.when(n > 9, r * 100 + n).otherwise(r * 10 + n) % 97) == 1


def _not_reserved(candidate: Column) -> Column:
    """Number ranges that were never given out."""
    return ~candidate.rlike(r"^(?:000|666|9..)-|-00-|-0000$")


#: Groups of 4-4-4-4 or 4-6-5 digits, or 13 to 19 digits without a break.
CARD = r"\b(?:[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|[0-9]{4}[ -]?[0-9]{6}[ -]?[0-9]{5}|[0-9]{13,19})\b"
_PATTERNS = dict([pii.EMAIL, *pii.NUMBERS[:-2]])
RECOGNISERS = (
    Recogniser("EMAIL_ADDRESS", _PATTERNS["EMAIL_ADDRESS"], 0.9, needs="@"),
    Recogniser("IP_ADDRESS", _PATTERNS["IP_ADDRESS"], 0.6, context=("ip", "address", "host", "server")),
    Recogniser("IBAN_CODE", r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}\b", 0.95, mod_97, ("iban", "account", "bank"), iban_text),
    Recogniser("CREDIT_CARD", CARD, 0.8, luhn, ("card", "visa", "credit", "debit", "payment")),
    Recogniser("US_SSN", _PATTERNS["US_SSN"], 0.5, _not_reserved, ("ssn", "social", "security")),
    Recogniser("PHONE_NUMBER", r"(?:\+[0-9]{1,3}[ .-]?|\b[0-9]{1,3}[ .-])?(?:\([0-9]{3}\)|\b[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}\b", 0.45, context=("phone", "call", "tel", "mobile")),
)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is computed once, however often it is used in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _spans_of(text: Column, rule: Recogniser) -> Column:
    """Spans of one recogniser: the text cut at its candidates, offsets summed up, candidates tested."""
    parts = F.split(F.regexp_replace(text, rule.pattern, f"{_MARK}$0{_MARK}"), _MARK)
    # A text without a candidate is one part.
    spans = _bound(parts, lambda p: F.when(F.size(p) > 1, _spans_between(text, p, rule)).otherwise(F.array().cast(SPANS)))
    return F.when(text.rlike(rule.needs), spans).otherwise(F.array().cast(SPANS))


def _spans_between(text: Column, parts: Column, rule: Recogniser) -> Column:
    none = F.array().cast("array<struct<start:int,end:int,found:string>>")
    begin = F.struct(F.lit(0).alias("at"), F.lit(False).alias("candidate"), none.alias("out"))

    def step(s: Column, part: Column) -> Column:
        end = s["at"] + F.length(part)
        one = F.struct(s["at"].alias("start"), end.alias("end"), part.alias("found"))
        out = F.when(s["candidate"], F.concat(s["out"], F.array(one))).otherwise(s["out"])
        return F.struct(end.alias("at"), (~s["candidate"]).alias("candidate"), out.alias("out"))

    found = F.aggregate(parts, begin, step, lambda s: s["out"])
    if rule.cut is not None:
        cut = F.transform(found, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), rule.cut(c["found"]).alias("found")))
        known = F.filter(cut, lambda c: c["found"].isNotNull())
        found = F.transform(known, lambda c: F.struct(c["start"].alias("start"), (c["start"] + F.length(c["found"])).alias("end"), c["found"].alias("found")))
    if rule.valid is not None:
        found = F.filter(found, lambda c: rule.valid(c["found"]))

    def scored(c: Column) -> Column:
        before = F.lower(F.substring(text, F.greatest(c["start"] - CONTEXT, F.lit(0)) + 1, F.least(c["start"], F.lit(CONTEXT))))
        bonus = F.when(before.rlike(rf"\b(?:{'|'.join(rule.context)})\b"), CONTEXT_BONUS).otherwise(0.0) if rule.context else F.lit(0.0)
        return F.struct(
            c["start"].alias("start"), c["end"].alias("end"), F.lit(rule.entity).alias("entity"),
            F.least(F.lit(rule.score) + bonus, F.lit(1.0)).alias("score"),
        )

    return F.transform(found, scored)


def find_entities(c: Column | str, entities: Sequence[str] | None = None, min_score: float = MIN_SCORE) -> Column:
    """``array<struct<start, end, entity, score>>`` of the entities of a text, in order and without overlaps.

    Candidates of all recognisers are found on their own, so one that fails its test hides nothing. A sweep from
    left to right keeps, of spans that overlap, the one with the higher score, then the longer one. Null texts give
    null; positions count characters from 0.
    """
    rules = [r for r in RECOGNISERS if entities is None or r.entity in entities]

    def spans(text: Column) -> Column:
        every = F.filter(F.concat(*[_spans_of(text, r) for r in rules]), lambda s: s["score"] >= min_score)
        worth = F.transform(
            F.array_sort(F.transform(every, lambda s: F.struct(s["start"].alias("start"), (-s["score"]).alias("less"), (-s["end"]).alias("far"), s["entity"].alias("entity")))),
            lambda s: F.struct(s["start"].alias("start"), (-s["far"]).alias("end"), s["entity"].alias("entity"), (-s["less"]).alias("score")),
        )
        found = _bound(worth, lambda w: F.when(F.size(w) > 1, F.aggregate(w, F.array().cast(SPANS), sweep)).otherwise(w))
        return F.when(text.isNull(), F.lit(None).cast(SPANS)).when(text.rlike("[0-9@]"), found).otherwise(F.array().cast(SPANS))

    def sweep(kept: Column, s: Column) -> Column:
        last = F.element_at(kept, -1)
        apart = s["start"] >= last["end"]
        better = (s["score"] > last["score"]) | ((s["score"] == last["score"]) & (s["end"] - s["start"] > last["end"] - last["start"]))
        own = F.array(s)
        return F.when(F.size(kept) == 0, own).when(apart, F.concat(kept, own)).when(
            better, F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), own)
        ).otherwise(kept)

    return _bound(F.replace(col(c), F.lit(_MARK), F.lit(_OTHER)), spans)


def mask_spans(c: Column | str, spans: Column) -> Column:
    """The text with each span replaced by ``<ENTITY>``; spans are in order and don't overlap."""
    text = col(c)
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(s: Column, span: Column) -> Column:
        between = F.substring(text, s["at"] + 1, span["start"] - s["at"])
        return F.struct(span["end"].alias("at"), F.concat(s["out"], between, F.lit("<"), span["entity"], F.lit(">")).alias("out"))

    masked = F.aggregate(spans, begin, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, masked).otherwise(text)


def mask_entities(c: Column | str, entities: Sequence[str] | None = None, min_score: float = MIN_SCORE) -> Column:
    """The text with its recognised entities masked; a null text stays null."""
    return mask_spans(c, find_entities(c, entities, min_score))
