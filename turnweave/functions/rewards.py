"""Expressions behind the reward functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnweave.functions import text as tx

# Fixed values.
DEFAULT_REWARD_MODEL = "nvidia/Qwen-3-Nemotron-32B-Reward"
NOTHINK_HINT = "nemotron"
NOTHINK_USER_SUFFIX = " /nothink"
NOTHINK_ANSWER_PREFIX = "<think>\n\n</think>\n\n"


def reward_model_format(model_id: Column, wanted: Column) -> Column:
    """``plain`` or ``nothink``: the wanted one if named, else judged by the model id."""
    return (
        F.when(wanted.isin("plain", "nothink"), wanted)
        .when(F.lower(model_id).contains(NOTHINK_HINT), F.lit("nothink"))
        .otherwise(F.lit("plain"))
    )


def reward_model_messages(user: Column, answer: Column, style: Column) -> Column:
    """The two-message conversation a reward model scores."""
    nothink = style == F.lit("nothink")
    asked = F.when(nothink, F.concat(user, F.lit(NOTHINK_USER_SUFFIX))).otherwise(user)
    given = F.when(nothink, F.concat(F.lit(NOTHINK_ANSWER_PREFIX), answer)).otherwise(answer)
    return F.array(
        F.struct(F.lit("user").alias("role"), asked.alias("content")),
        F.struct(F.lit("assistant").alias("role"), given.alias("content")),
    )


def reward_model_text(messages: Column) -> Column:
    """The same conversation as text, for scorers without a chat template."""
    return F.concat(
        F.lit("User: "), messages[0]["content"], F.lit("\nAssistant: "), messages[1]["content"]
    )


def think_format(text: Column, require_answer: bool = True) -> Column:
    """1.0 for one think block at the start followed by an answer, else 0.0."""
    pattern = tx.THINK_THEN_ANSWER if require_answer else tx.THINK_ONLY
    return text.rlike(pattern).cast("double")


def last_logit(logits: Column) -> Column:
    """A model's output row as one score."""
    return F.try_element_at(logits, F.lit(-1)).cast("double")
