import pytest
from pyspark.sql import functions as F

from promptloom.functions import prompts, templates as t


def test_render_leaves_data_alone(column):
    show = lambda x: prompts.render("<{a}> {{b}}", a=F.col(x))
    assert column(show, ["{c} \\ $1", "", None]) == ["<{c} \\ $1> {b}", "<> {b}", None]


def test_render_needs_every_field():
    with pytest.raises(ValueError, match="missing"):
        prompts.render("{missing}")


def test_empty_context_counts_as_absent(spark):
    rows = spark.createDataFrame([("i", "r", None), ("i", "r", ""), ("i", "r", "c")], "i string, r string, c string")
    plain, empty, full = [r[0] for r in rows.coalesce(1).select(prompts.training_text("i", "r", "c")).collect()]
    assert plain == empty == f"{t.INTRO}\n\n### Instruction:\ni\n\n### Response:\nr\n\n### End"
    assert full == f"{t.INTRO}\n\n### Instruction:\ni\n\nInput:\nc\n\n### Response:\nr\n\n### End"


def test_forms(column):
    assert column(prompts.entity_extraction, ["q"])[0].endswith("<</SYS>> q [/INST] ")
    assert column(lambda x: prompts.single_turn(x, "S"), ["q"]) == ["\n<s>[INST]<<SYS>>\nS\n<</SYS>>\n\nq\n[/INST]\n"]
    assert column(lambda x: prompts.single_turn(x, "S", "compact"), ["q"]) == [
        "<s>[INST]<<SYS>>\nS\n<</SYS>>\n\n\nq[/INST]\n"
    ]
    assert column(prompts.dataset_response, ["r", None]) == ["r\n### End", None]


def test_prefixes_are_idempotent(column):
    once = column(prompts.passage, ["a", "passage: a", "passage:a", None])
    assert once == ["passage: a", "passage: a", "passage:a", None]
    assert column(prompts.query, ["query: q", "q"]) == ["query: q", "query: q"]
    assert column(lambda x: prompts.bge_query(x, None), ["q"]) == ["q"]


def test_instructor_leaves_out_missing_parts(spark):
    rows = spark.createDataFrame([("doc", "science", "search"), ("doc", None, None)], "t string, d string, o string")
    got = [r[0] for r in rows.coalesce(1).select(prompts.instructor("t", "d", "o")).collect()]
    assert got == ["Represent the science doc for search:", "Represent the doc:"]


def test_sql_schema_text(column):
    assert column(prompts.schema_text, [" CREATE TABLE t (a VARCHAR)\n"]) == ["t (a STRING)"]


def test_captions_collapse_spaces(spark):
    row = spark.range(1).select(prompts.caption(F.lit(" red"), F.lit("casual"), F.lit("hat"))).first()
    assert row[0] == "Create a caption for this image of red casual hat :"
