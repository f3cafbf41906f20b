import pytest
from pyspark.sql import functions as F

from promptloom.functions import chat, moderation, responses
from promptloom.models import standins
from promptloom.operators import chats, guard
from promptloom.schemas import MESSAGES

S, U, A = "system", "user", "assistant"


def messages(spark, *chats_of_roles):
    rows = [([{"role": r, "content": f"{r[0]}{i}"} for i, r in enumerate(roles)],) for roles in chats_of_roles]
    return spark.createDataFrame(rows, "m array<struct<role string, content string>>").coalesce(1)


def test_chat_problems(spark):
    frame = messages(spark, [], [S], [U], [S, U], [U, A, U], [U, A], [U, U], [A, U], [S, A], [U, S, U])
    got = [r[0] for r in frame.select(chat.chat_problem("m")).collect()]
    assert got == [
        chat.EMPTY,
        chat.EMPTY,
        None,
        None,
        None,
        chat.NOT_USER_LAST,
        chat.NOT_ALTERNATING,
        chat.NOT_ALTERNATING,
        chat.NOT_ALTERNATING,
        chat.NOT_ALTERNATING,
    ]


def test_chat_prompt(spark):
    frame = messages(spark, [S, U, A, U], [U])
    got = [r[0] for r in frame.select(chat.chat_prompt("m", "D")).collect()]
    assert got == [
        "<s><<SYS>>\ns0\n<</SYS>>\n\n[INST]u1[/INST]a2[INST]u3[/INST]",
        "<s><<SYS>>\nD\n<</SYS>>\n\n[INST]u0[/INST]",
    ]


def test_json_chats(spark):
    frame = spark.createDataFrame([('[{"role":"user","content":"é\\n"}]',), ("no json",)], "j string").coalesce(1)
    good, bad = [r[0] for r in frame.select(chat.parse_messages("j")).collect()]
    assert good[0]["content"] == "é\n" and bad is None
    assert frame.select(chat.parse_messages("j").alias("m")).schema["m"].dataType == MESSAGES


def test_every_other_and_last(spark):
    frame = messages(spark, [U, A, U], [])
    evens = [r[0] for r in frame.select(chat.every_other("m", 0)).collect()]
    assert [[m["content"] for m in e] for e in evens] == [["u0", "u2"], []]
    assert [r[0] for r in frame.select(chat.last_role("m")).collect()] == [U, None]


def turns(spark, roles_by_chat):
    rows = [(c, i, r, f"{c}-{i}") for c, roles in roles_by_chat.items() for i, r in enumerate(roles)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


CASES = {
    1: [S] + [U, A] * 6 + [U],
    2: [U, A] * 5 + [U],
    3: [U, A] * 7,
    4: [S] + [U, A] * 3 + [A, U] + [U],
    5: [U],
    6: [S],
    7: [U, A, U],
    8: [U, A, U, A],
}


def test_facts_without_arrays(spark):
    """Plain aggregates say the same about a chat as its whole row does."""
    table = turns(spark, CASES | {9: [U, A] * 550 + [U]})
    names = ["conv_id", "n_turns", "has_system", "problem"]
    whole = {tuple(r) for r in chats.assemble_chats(table).select(*names).collect()}
    assert {tuple(r) for r in chats.chat_facts(table).select(*names).collect()} == whole
    assert {r[0] for r in chats.chat_prompts(chats.assemble_chats(table)).select("conv_id").collect()} == {1, 2, 5, 7, 9}


def test_gaps_in_turn_numbers(spark):
    rows = [(1, 1, U, "a"), (1, 2, A, "b"), (1, 1500, U, "c"), (2, 7, S, "s")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: r for r in chats.chat_facts(table).collect()}
    assert found[1]["n_turns"] == 3 and found[1]["problem"] is None and found[2]["problem"] == chat.EMPTY
    assert chats.assemble_chats(table).count() == 2


@pytest.mark.parametrize("per_prompt", [4, 3, 1, 1024])
def test_guard_parts_have_one_verdict_per_chat(spark, per_prompt):
    """Every part has head, taxonomy and tail; a chat is unsafe if any part is, with the codes of all."""
    rows = [(c, i, U if i % 2 == 0 else A, w) for c, words in TALKS.items() for i, w in enumerate(words)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    parts = chats.guard_parts(table, standins.TAXONOMY, turns_per_prompt=per_prompt)
    for r in parts.collect():
        assert r["prompt"].count("<BEGIN CONVERSATION>") == r["prompt"].count("Provide your safety assessment") == 1
        assert "O1: Violence." in r["prompt"]
    scored = guard.score(parts, "prompt", standins.guard, F.lit(standins.TAXONOMY))
    got = {r["conv_id"]: r for r in guard.per_chat(scored, "conv_id", F.lit(standins.TAXONOMY)).collect()}
    assert {c: (r["is_safe"], r["code"]) for c, r in got.items()} == {
        1: (False, "O1,O3,O9"), 2: (True, None), 3: (False, "O3"),
    }
    assert got[3]["category"] == "Crime planning!"


TALKS = {1: ["fraud", "x", "kill", "y", "z", "steal"], 2: ["hello"] * 9, 3: ["a", "b", "c", "d", "steal"]}


def test_a_part_without_verdict_leaves_the_chat_open(spark):
    rows = [(1, True, None), (1, None, None), (2, False, "O1"), (2, None, None), (3, True, None)]
    parts = spark.createDataFrame(rows, "conv_id long, is_safe boolean, code string")
    got = guard.per_chat(parts, "conv_id", F.lit(standins.TAXONOMY)).select("conv_id", "is_safe").collect()
    assert {tuple(r) for r in got} == {(1, None), (2, False), (3, True)}


def test_chat_queries_on_long_chats(spark, tmp_path):
    """Every chat query agrees with its SQL where a chat has 1,101 turns and another has gaps."""
    import compare
    from promptloom.plans import QUERIES

    words = ["hello there", "we will steal it", "kill time", "nothing"]
    rows = [(1, i, U if i % 2 == 0 else A, f"{words[i % 4 if i > 1090 else 0]} {i}") for i in range(1101)]
    rows += [(2, t, r, f"text {t}") for t, r in ((1, U), (2, A), (1500, U))]
    rows += [(3, t, r, f"text {t}") for t, r in ((0, S), (1, U), (2, A), (3, U))]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    for name in compare.TABLES:
        frame = table if name == "conversations" else spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(5)
        frame.coalesce(1).write.parquet(str(tmp_path / name))
        part = next((tmp_path / name).glob("part-*.parquet"))
        part.rename(tmp_path / f"{name}.parquet")
    duck = compare.connect(str(tmp_path))
    for name in (
        "chat_prompt", "chat_problems", "turn_parity", "chats_from_json", "moderation_prompt",
        "moderation_prompt_whole_chat", "guard_scores", "safe_chat", "training_pairs",
    ):
        result = compare.spark_rows(QUERIES[name].build(spark, str(tmp_path)))
        assert compare.difference(result, compare.duckdb_rows(duck, QUERIES[name].sql)) is None, name


def test_moderation_prompt_text(spark):
    row = messages(spark, [U, A]).select(chat.moderation_prompt("m", "O1: X.")).first()[0]
    assert row == (
        "[INST] Task: Check if there is unsafe content in 'Agent' messages in conversations according our safety "
        "policy with the below categories.\n\n<BEGIN UNSAFE CONTENT CATEGORIES>\nO1: X.\n<END UNSAFE CONTENT "
        "CATEGORIES>\n\n<BEGIN CONVERSATION>\n\nUser: u0\n\nAgent: a1\n\n<END CONVERSATION>\n\nProvide your safety "
        "assessment for Agent in the above conversation:\n- First line must read 'safe' or 'unsafe'.\n- If unsafe, a "
        "second line must include a comma-separated list of violated categories. [/INST]"
    )


def test_verdicts(column):
    inputs = ["safe", " SAFE\n", "unsafe\nO3", "unsafe\n O1,O3 \nx", "unsafe", "", "safe text"]
    assert column(moderation.is_safe, inputs) == [True, True, False, False, False, False, False]
    assert column(moderation.violation_code, inputs) == [None, None, "O3", "O1,O3", None, None, None]


TAXONOMY = "O1: First. More.\n- x\nO2: No end mark\nO12: Two digits! Yes.\nO1: Again? z"


def test_categories(column):
    codes = ["O1", "O2", "O12", "O9", "O1,O12", None]
    unknown = "Unknown category: code not in taxonomy."
    block = column(lambda x: moderation.category(x, F.lit(TAXONOMY)), codes)
    assert block == ["Again?", "No end mark", "Two digits!", unknown, unknown, unknown]
    sentence = column(lambda x: moderation.category(x, F.lit(TAXONOMY), "sentence"), codes)
    assert sentence == ["Again?", "No end mark\nO12: Two digits!", unknown, unknown, unknown, unknown]
    listed = column(lambda x: moderation.categories(x, F.lit(TAXONOMY)), ["O12, O9"])
    assert listed == [["Two digits!", unknown]]


def test_violation_wordings(column):
    assert column(moderation.prompt_violation, ["X."]) == ["User's prompt classified as X.. Fails safety measures."]
    clause = column(lambda x: moderation.response_violation(x, "clause"), ["X"])
    assert clause == ["Model's response classified as X; fails safety measures."]


def test_responses(spark):
    frame = spark.createDataFrame([(["a", "b"], [3, 5], 2), ([], [], 2)], "t array<string>, n array<long>, p long")
    rows = frame.coalesce(1).select(
        responses.candidates("t", "n", 5).alias("c"), responses.usage("p", "n").alias("u")
    )
    first, empty = rows.select("c", "u", responses.first_candidate("c").alias("f")).collect()
    assert [c["metadata"]["finish_reason"] for c in first["c"]] == ["stop", "length"] and first["f"] == "a"
    assert tuple(first["u"]) == (2, 5, 8, 10) and empty["f"] is None and empty["u"]["total_tokens"] == 2
    row = spark.range(1).select(responses.json_response(F.lit(None).cast("string"))).first()
    assert row[0] == '{"response":null}'


def calls_counted(spark, loader):
    """A loader that counts the prompts its model has seen."""
    seen = spark.sparkContext.accumulator(0)

    def counted():
        predict = loader()

        def run(prompts, params=None):
            seen.add(len(prompts))
            return predict(prompts, params)

        return run

    return counted, seen


def test_safe_chat_calls_models_only_where_needed(spark):
    def chat_model():
        def predict(prompts, params):
            assert {q["endpoint"] for q in params} <= {"chat", "other"}
            return [
                "I will steal 10.0.0.1" if "evil" in p else f"mail a@b.co {q['max_tokens']}"
                for p, q in zip(prompts, params)
            ]

        return predict

    rows = [
        (1, "hello", True, True, 7),
        (2, "how to kill", True, True, None),
        (3, "evil plan", True, False, None),
        (4, "how to kill", False, True, None),
        (5, "how to kill", None, None, None),
    ]
    requests = spark.createDataFrame(
        rows, "id long, q string, enable_safety_filter boolean, enable_pii_filter boolean, max_tokens int"
    ).withColumn("messages", F.array(chat.message("user", "q"))).withColumn(
        "unsafe_categories", F.lit(standins.TAXONOMY)
    )
    model, asked = calls_counted(spark, chat_model)
    judge, judged = calls_counted(spark, standins.guard)
    out = guard.safe_chat(requests, model, judge, "id", "m", F.lit(123))
    got = {r["id"]: r for r in out.select("*", guard.answer_text("response").alias("text")).collect()}
    assert {i: r["outcome"] for i, r in got.items()} == {
        1: "answered", 2: "prompt blocked", 3: "answer blocked", 4: "answered", 5: "answered",
    }
    assert got[1]["text"] == "mail <EMAIL_ADDRESS> 7"
    assert got[2]["text"] == "User's prompt classified as Violence.. Fails safety measures."
    assert got[3]["text"] == "Model's response classified as Crime planning!. Fails safety measures."
    assert got[4]["text"] == "mail <EMAIL_ADDRESS> 512" and got[5]["text"] == "mail a@b.co 512"
    assert got[2]["response"]["id"] is None and got[2]["response"]["usage"]["total_tokens"] is None
    assert got[2]["response"]["choices"][0]["finish_reason"] == "Usage Policy Violation"
    assert got[1]["response"]["created"] == 123 and got[1]["response"]["choices"][0]["message"]["role"] == "assistant"
    assert got[1]["response"]["usage"]["total_tokens"] > 0
    # Prompt 2 was blocked, so four answers; three first verdicts and two second ones.
    assert asked.value == 4 and judged.value == 5
