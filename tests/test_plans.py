"""The physical plans we rely on."""

import pytest
from pyspark.sql import functions as F

from promptloom.functions import prompts, text, tokens
from promptloom.operators import chats, chunk, product, sample, search
from promptloom.plans import QUERIES
from promptloom.plans.registry import table


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


MODEL_FREE = [
    "summary_prompt", "clean_after_last", "clean_after_first", "extract_response", "stop_words", "token_counts",
    "training_text", "pair_text", "compact_text", "tokenize_pairs", "chat_problems", "moderation_prompt",
    "guard_verdicts", "taxonomy_blocks", "pii_mask", "html_strip", "chunk_characters", "chunk_tokens",
    "description_prompts", "token_usage", "drop_prompt", "completion_records", "split_fraction",
]


@pytest.mark.parametrize("name", MODEL_FREE)
def test_no_python_where_no_model_runs(spark, sf, name):
    text_plan = plan(QUERIES[name].build(spark, sf))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "Cartesian", "NestedLoop"):
        assert node not in text_plan


def test_one_python_step_in_batch_inference(spark, sf):
    text_plan = plan(QUERIES["batch_inference"].build(spark, sf), "simple")
    assert text_plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in text_plan


def test_samples_and_splits_do_not_shuffle(spark, sf):
    docs = table(spark, sf, "documents")
    for df in (
        sample.sample_rows(docs, "doc_id", 50),
        sample.train_test_split(docs, "doc_id", 0.2),
        sample.first_rows(docs, "doc_id", 50),
    ):
        assert "Exchange" not in plan(df) and "TakeOrdered" not in plan(df)
    assert "PushedFilters: [IsNotNull(doc_id), LessThanOrEqual(doc_id" in plan(sample.first_rows(docs, "doc_id", 50))


def test_no_single_partition_window_over_data(spark, sf):
    """Only the table of bucket offsets is gathered in one partition."""
    docs = table(spark, sf, "documents").select("doc_id")
    text_plan = plan(sample.with_position(docs, "doc_id"), "simple")
    assert text_plan.count("SinglePartition") == 1 and "BroadcastHashJoin" in text_plan


def test_prompts_and_chunks_are_narrow_and_pruned(spark, sf):
    docs = table(spark, sf, "documents")
    for df in (
        docs.select("doc_id", prompts.summary("text")),
        chunk.chunk_characters(docs.select("doc_id", "text")),
        docs.select("doc_id", text.strip("text"), tokens.n_tokens("text")),
    ):
        assert "Exchange" not in plan(df) and "ReadSchema: struct<doc_id:bigint,text:string>" in plan(df)


def test_chats_are_read_and_shuffled_once(spark, sf):
    assembled = chats.assemble_chats(table(spark, sf, "conversations"))
    text_plan = plan(chats.chat_prompts(assembled), "simple")
    assert text_plan.count("FileScan") == 1 and text_plan.count("Exchange") == 1


def test_combinations_do_not_join(spark, sf):
    items = table(spark, sf, "part").select("p_name")
    text_plan = plan(product.combinations(items, ["a", "b"], ["c"]))
    assert "Join" not in text_plan and "Exchange" not in text_plan


def test_search_filter_reaches_the_scan_and_top_k_is_partial(spark, sf):
    vecs = table(spark, sf, "embeddings")
    asked = vecs.where("vec_id = 1").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_embedding"))
    text_plan = plan(search.top_k(asked, vecs, 5, item_id="vec_id", where={"label": 3}))
    assert "EqualTo(label,3)" in text_plan and "MapInArrow" in text_plan
    assert "WindowGroupLimit" in text_plan and "Join" not in text_plan


def test_not_like_is_pushed_down(spark, sf):
    docs = table(spark, sf, "documents").where(~F.col("source").contains("src1"))
    assert "Not(StringContains(source,src1))" in plan(docs)


def test_instruction_dataset_reads_each_source_once(spark, sf):
    """Documents, parts, and the two sides of the turns; one shuffle of pairs for the duplicates."""
    text_plan = plan(QUERIES["instruction_dataset"].build(spark, sf), "simple")
    assert text_plan.count("FileScan") == 4 and text_plan.count("hashpartitioning(prompt") == 1


def test_throughput_calls_the_model_once(spark, sf):
    assert plan(QUERIES["throughput"].build(spark, sf), "simple").count("MapInArrow") == 1


def test_large_inputs_are_not_dealt_out_anew(spark, sf):
    from promptloom.sources import readers

    docs = table(spark, sf, "documents").repartition(readers.TINY, "doc_id")
    assert "RoundRobin" not in plan(readers.balanced(docs))


def test_model_stage_asks_for_its_profile(spark):
    from promptloom.models import standins
    from promptloom.operators import generate

    frame = spark.createDataFrame([("a", 1)], "p string, n int")
    out = generate.generate(frame, "p", "o", standins.answer_generator, n_partitions=3)
    assert "RoundRobinPartitioning(3)" in plan(out, "simple")
