"""Chats stored by turn: whole chats, newest user messages, next turns."""

import random

import pytest
from pyspark.sql import functions as F

from turnweave.functions import chat
from turnweave.operators.transforms import messages_to_prompt
from turnweave.sources.turns import (
    TurnColumns,
    answered_turns,
    assemble_chats,
    latest_user_text,
    with_next_turn,
)

ROLES = ["user", "assistant", "system", None]


@pytest.fixture(scope="module")
def rows():
    """Chats of up to 40 turns with gaps in the numbering; chat 3 has no user turn."""
    draw = random.Random(5)
    found = []
    for chat_id in range(8):
        turns = sorted(draw.sample(range(60), draw.choice([1, 2, 5, 40])))
        for turn in turns:
            role = draw.choice(ROLES[1:] if chat_id == 3 else ROLES)
            found.append((chat_id, turn, role, draw.choice(["a", "bb", "c c", None])))
    # One chat begins late and skips many parts.
    found += [(9, 25, "user", "x"), (9, 26, "user", "y"), (9, 900, "assistant", "z"), (9, 4000, "user", "w")]
    return found


@pytest.fixture(scope="module")
def turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def by_chat(rows):
    chats = {}
    for chat_id, *turn in sorted(rows, key=lambda r: r[:2]):
        chats.setdefault(chat_id, []).append(turn)
    return chats


def test_one_row_per_chat(turns, rows):
    chats = assemble_chats(turns).collect()
    assert len(chats) == len(by_chat(rows))
    found = {r.conv_id: [tuple(m) for m in r.messages] for r in chats}
    assert found == {c: [tuple(t[1:]) for t in ts] for c, ts in by_chat(rows).items()}


@pytest.mark.parametrize("template", [chat.PLAIN, chat.CHATML])
def test_prompts_without_answers(turns, rows, template):
    def prompts(prompts_only):
        asked = assemble_chats(turns, prompts_only=prompts_only).transform(messages_to_prompt(template, ("conv_id",)))
        return {r.conv_id: r.prompt for r in asked.collect()}

    assert prompts(True) == prompts(False)
    assert len(prompts(True)) == len(by_chat(rows))
    assert all(text.count(template.header) == 1 and text.endswith(template.header) for text in prompts(True).values())


def test_turn_numbers_may_be_anything(spark):
    """Turns numbered by time stamps make one row and no more work."""
    stamps = [(1, 0, "user", "a"), (1, 1_700_000_000_000_000, "assistant", "b"), (1, 1_800_000_000_000_000, "user", "c")]
    turns = spark.createDataFrame(stamps, "conv_id long, turn long, role string, text string")
    assert [len(r.messages) for r in assemble_chats(turns).collect()] == [3]
    assert [r.user_text for r in latest_user_text(turns).collect()] == ["c"]
    assert {r.turn: r.next and r.next.content for r in with_next_turn(turns).collect()} == {0: "b", stamps[1][1]: "c", stamps[2][1]: None}


def test_a_chat_too_large_for_a_row_is_named(turns):
    with pytest.raises(Exception, match="chat [0-9]+ has more than 3 bytes"):
        assemble_chats(turns, most_bytes=3).collect()


@pytest.mark.parametrize("span", [1, 2, 7, 1024])
def test_next_turn(turns, rows, span):
    found = {
        (r.conv_id, r.turn): r.next and tuple(r.next) for r in with_next_turn(turns, span=span).collect()
    }
    expected = {}
    for chat_id, listed in by_chat(rows).items():
        for turn, following in zip(listed, [*listed[1:], None]):
            expected[chat_id, turn[0]] = following and tuple(following)
    assert found == expected


def test_answered_turns_under_other_names(spark, turns):
    names = TurnColumns("dialog", "n", "who", "said")
    renamed = turns.toDF("dialog", "n", "who", "said")
    mine = {tuple(r) for r in answered_turns(renamed, names, span=2).collect()}
    assert mine == {tuple(r) for r in answered_turns(turns).collect()}


def test_latest_user_text(turns, rows):
    found = latest_user_text(turns).collect()
    expected = {}
    for chat_id, listed in by_chat(rows).items():
        said = [text or "" for _, role, text in listed if role == "user"]
        expected[chat_id] = said[-1] if said else " ".join(text or "" for *_, text in listed)
    assert {r.conv_id: r.user_text for r in found} == expected and len(found) == len(expected)


def test_chats_need_one_shuffle(spark):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    chats = assemble_chats(turns)
    chats.collect()
    final = chats._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
    assert "Join" not in final


def test_messages_stay_one_row_per_example(spark):
    """Nested input needs no grouping at all."""
    nested = spark.createDataFrame(
        [([("user", "a"), ("assistant", "b")], "k")],
        "messages array<struct<role:string,content:string>>, answer_key string",
    )
    prompts = nested.transform(messages_to_prompt(None))
    assert "Exchange" not in prompts._jdf.queryExecution().executedPlan().toString()
    row = prompts.first()
    assert [tuple(m) for m in row.prompt] == [("user", "a")] and row.answer_key == "k"
    assert prompts.columns == ["prompt", "answer_key"]
    assert nested.where(F.size("messages") > 9).transform(messages_to_prompt()).count() == 0
