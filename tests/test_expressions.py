"""Scalar expressions on hand-made cases."""

import math

import pytest
from pyspark.sql import functions as F

from turnweave.functions import chat, decisions, judging, rewards, stages, text, tokens
from turnweave.operators.training import stable_hash
from turnweave.sources.rubrics import BUILT_IN, FORMAT_STYLE, GENERAL, MATH_REASONING, Category, Rubric


def values(spark, cases, expression):
    frame = spark.createDataFrame(list(enumerate(cases)), "id int, x string")
    return [r.y for r in frame.select("id", expression(F.col("x")).alias("y")).orderBy("id").collect()]


def test_strip_think(spark):
    cases = {
        "<think>a</think> b": "b",
        "<think>a\nb</think>\n\nc <think>d</think>e": "c e",
        "<think>open": "<think>open",
        "</think>x": "</think>x",
        "<think>a</think> 　\u0085 \x1c\x1fz": "z",
        "": "",
    }
    assert values(spark, cases, text.strip_think) == list(cases.values())


def test_strip_covers_unicode_whitespace(spark):
    space = "\t\n\x0b\x0c\r \x1c\x1d\x1e\x1f\x85\xa0       　"
    cases = [space + "a b" + space, "​kept​", space, "line\n"]
    assert values(spark, cases, text.strip) == [c.strip() for c in cases]
    assert values(spark, cases, text.lstrip) == [c.lstrip() for c in cases]


def test_long_texts(spark):
    long = "<think>" + "x\n" * 600_000 + "</think> done"
    assert values(spark, [long], chat.normalize_completion) == ["done"]
    assert values(spark, ["a{" + "}\n" * 600_000], text.isolate_json) == ["{" + "}\n" * 599_999 + "}"]


def test_isolate_json(spark):
    cases = {'a {"b": {}} c': '{"b": {}}', "no": "", "} {": "", "{a}\nx {b} y": "{a}\nx {b}"}
    assert values(spark, cases, text.isolate_json) == list(cases.values())


def test_think_format(spark):
    cases = {
        "<think>a</think> b": 1.0,
        "<think></think>b": 1.0,
        "<think>a\n</think>\n\nb\n": 1.0,
        "<think>a</think>  \n": 0.0,
        " <think>a</think> b": 0.0,
        "<think>a b": 0.0,
        "<think>a</think><think>b</think> c": 0.0,
        "a </think> b": 0.0,
        "": 0.0,
    }
    assert values(spark, cases, rewards.think_format) == list(cases.values())
    lenient = values(spark, ["<think>a</think>"], lambda x: rewards.think_format(x, False))
    assert lenient == [1.0]


MESSAGES = "array<struct<role:string,content:string>>"


def on_messages(spark, cases, expression):
    frame = spark.createDataFrame(list(enumerate(cases)), f"id int, m {MESSAGES}")
    return [r.y for r in frame.select("id", expression(F.col("m")).alias("y")).orderBy("id").collect()]


def test_without_assistant_keeps_missing_roles(spark):
    cases = [[("user", "a"), ("assistant", "b"), (None, "c"), ("system", None)], [], None]
    kept = on_messages(spark, cases, chat.without_assistant)
    assert [[tuple(m) for m in row] for row in kept] == [
        [("user", "a"), (None, "c"), ("system", None)],
        [],
        [],
    ]


def test_plain_prompt_defaults(spark):
    cases = [[("user", "a"), (None, "c"), ("system", None)], []]
    render = lambda m: chat.render_prompt(m, chat.PLAIN)
    assert on_messages(spark, cases, render) == [
        "user: a\nuser: c\nsystem: \nassistant: ",
        "assistant: ",
    ]


def test_chatml_prompt(spark):
    render = lambda m: chat.render_prompt(m, chat.CHATML)
    assert on_messages(spark, [[("user", "hi")]], render) == [
        "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n"
    ]


def test_last_user_text(spark):
    cases = {
        "two users": ([("user", "a"), ("assistant", "b"), ("user", "c"), ("system", "d")], "c"),
        "no content": ([("user", "a"), ("user", None)], ""),
        "no user": ([("system", "a"), ("assistant", None), (None, "b")], "a  b"),
        "nothing": ([], ""),
    }
    found = on_messages(spark, [c[0] for c in cases.values()], chat.last_user_text)
    assert found == [c[1] for c in cases.values()]
    whole = lambda m: chat.last_user_text(m, F.lit("as is"))
    assert on_messages(spark, [[("user", "a")]], whole) == ["as is"]


def test_completion_as_messages(spark):
    cases = [[("assistant", " <think>x</think> a"), ("assistant", "b")], [(None, None)], []]
    plain = F.lit("  text")
    assert on_messages(spark, cases, lambda m: chat.normalize_completion(plain, m)) == ["a", "", "text"]
    assert on_messages(spark, cases, lambda m: chat.completion_text(plain, m)) == [
        " <think>x</think> a",
        "  text",
        "  text",
    ]
    assert values(spark, [None], chat.normalize_completion) == [""]


def test_train_mask_without_role(spark):
    marked = on_messages(spark, [[("assistant", "a"), (None, "b"), ("user", "c")]], chat.train_mask)
    assert [(m.train, m.train_eos) for m in marked[0]] == [(True, True), (False, False), (False, False)]


def test_reward_model_format(spark):
    cases = [("acme/Nemotron", "auto"), ("acme/rm", "auto"), ("acme/rm", "nothink"), ("x-NEMOTRON", "plain")]
    frame = spark.createDataFrame(cases, "model string, wanted string")
    found = frame.select(rewards.reward_model_format(F.col("model"), F.col("wanted")).alias("f"))
    assert [r.f for r in found.collect()] == ["nothink", "plain", "nothink", "plain"]


def test_last_logit(spark):
    frame = spark.createDataFrame([([0.5],), ([1.0, 2.0, 3.0],), ([],), (None,)], "x array<double>")
    found = [r.y for r in frame.select(rewards.last_logit(F.col("x")).alias("y")).collect()]
    assert found == [0.5, 3.0, None, None]


def test_generated_suffix(spark):
    cases = [([1, 2, 3], [1]), ([1], [1]), ([1], [1, 2]), ([1, 2], [])]
    frame = spark.createDataFrame(cases, "o array<int>, p array<int>")
    found = frame.select(tokens.generated_suffix(F.col("o"), F.col("p")).alias("y")).collect()
    assert [r.y for r in found] == [[2, 3], [], [], [1, 2]]


def test_word_count(spark):
    assert values(spark, ["a  b\nc", "", " ", None], tokens.word_count) == [3, 0, 0, 0]


def test_stable_hash_is_md5(spark):
    import hashlib

    keys = ["0", "17", "é"]
    expected = [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) for k in keys]
    assert values(spark, keys, stable_hash) == expected


def test_stage_algorithms(spark):
    frame = spark.range(8).crossJoin(spark.range(3).withColumnRenamed("id", "stage"))
    algorithm = stages.stage_algorithm(F.col("id"), F.col("stage").cast("int"))
    found = {(r.id, r.stage): r.alg for r in frame.select("id", "stage", algorithm.alias("alg")).collect()}
    assert all(found[m, 0] == "sft" for m in range(8))
    dpo = {(m, s) for (m, s), alg in found.items() if alg == "dpo"}
    assert dpo == {(2, 1), (3, 1), (6, 1), (7, 1), (4, 2), (5, 2), (6, 2), (7, 2)}


def test_instructions_print_weights_as_written():
    rubric = Rubric((Category("a", 1, "Is a?"), Category("b", 0.5, "Is b?")), "Judge.", 1, 10)
    assert judging.judge_instructions(rubric) == (
        "Judge.\nCategories:\n- a (1): Is a?\n- b (0.5): Is b?\nUse scale 1-10."
    )
    assert judging.judge_instructions(rubric, local=True).startswith(
        "You are a strict, fair LLM judge. Score each category 0-5 and return ONLY a JSON object "
        "with keys 'scores' and 'reasons'.\nCategories:\n- a (1)"
    )


@pytest.mark.parametrize(
    "rubric, weight", [(BUILT_IN, 5.0), (GENERAL, 5.0), (FORMAT_STYLE, 5.5), (MATH_REASONING, 5.2)]
)
def test_rubric_weights(rubric, weight):
    assert math.isclose(rubric.total_weight, weight)


# (format, helpful, correct, reasoning, style, safety) → name, index, reason, number of advices
DECISIONS = [
    ((3.4, 5, 5, 5, 5, 5), ("SFT", 0, decisions.FORMAT_REASON), [decisions.FORMAT_ADVICE]),
    ((3.5, 5, 3.1, 5, 5, 5), ("GRPO", 1, decisions.REASONING_REASON), [decisions.REASONING_ADVICE]),
    ((3.5, 5, 3.2, 3.1, 5, 5), ("GRPO", 1, decisions.REASONING_REASON), [decisions.REASONING_ADVICE]),
    ((3.5, 3.1, 3.2, 3.2, 5, 5), ("DPO", 2, decisions.HELPFUL_REASON), [decisions.HELPFUL_ADVICE]),
    ((3.5, 3.2, 3.2, 3.2, 3.4, 5), ("SFT", 0, decisions.STYLE_REASON), []),
    ((3.5, 3.5, 3.2, 3.2, 3.4, 5), ("SFT", 0, decisions.STYLE_REASON), [decisions.STYLE_ADVICE]),
    ((3.5, 3.2, 3.2, 3.2, 3.5, 3.9), ("SFT", 0, decisions.SAFETY_REASON), [decisions.SAFETY_ADVICE]),
    ((3.5, 3.2, 3.2, 3.2, 3.5, 4.0), ("SFT", 0, decisions.DEFAULT_REASON), []),
    ((None,) * 6, ("SFT", 0, decisions.DEFAULT_REASON), []),
    (
        (0, 0, 0, 0, 0, 0),
        ("SFT", 0, decisions.FORMAT_REASON),
        [decisions.FORMAT_ADVICE, decisions.REASONING_ADVICE, decisions.SAFETY_ADVICE],
    ),
]


def test_decisions(spark):
    keys = [c.key for c in BUILT_IN.categories]
    rows = [
        (i, {k: float(v) for k, v in zip(keys, case[0]) if v is not None})
        for i, case in enumerate(DECISIONS)
    ]
    frame = spark.createDataFrame(rows, "id int, m map<string,double>")
    found = frame.select(
        "id",
        decisions.next_algorithm(F.col("m")).alias("next"),
        decisions.suggestions(F.col("m")).alias("advice"),
    ).orderBy("id")
    for row, (_, expected, advice) in zip(found.collect(), DECISIONS):
        assert tuple(row.next) == expected
        assert row.advice == advice
