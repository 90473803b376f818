"""Reward functions and their weighted sum.

A reward function is ``f(prompt, completion, **columns) -> Column``. Prompts and completions
may be texts or message lists; what the functions here need of either is read by its type.
Functions over lists, ``f(prompts, completions, **columns) -> list[float]``, are taken as they are
and called on Arrow batches, see :func:`list_reward`.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce, wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.functions import chat, rewards
from turnweave.operators import models
from turnweave.operators.transforms import find

RewardFunction = Callable[..., Column]
ListFunction = Callable[..., list]


@dataclass(frozen=True)
class Value:
    """A prompt or completion column and whether it holds message lists."""

    column: Column
    messages: bool = False

    @classmethod
    def of(cls, df: DataFrame, name: str) -> Value:
        return cls(F.col(name), isinstance(df.schema[name].dataType, T.ArrayType))

    def user_text(self) -> Column:
        """A text prompt whole; of a list the newest user message."""
        return chat.last_user_text(self.column) if self.messages else self.column

    def text(self) -> Column:
        nothing = F.lit(None).cast("string")
        return chat.completion_text(nothing, self.column) if self.messages else chat.completion_text(self.column)

    def answer(self) -> Column:
        nothing = F.lit(None).cast("string")
        return chat.normalize_completion(nothing, self.column) if self.messages else chat.normalize_completion(self.column)


def typed(function: Callable[..., Column]) -> RewardFunction:
    """A reward function over values that know their type, also callable with plain text columns."""

    @wraps(function)
    def reward(prompt: Column | Value, completion: Column | Value, **columns: Column) -> Column:
        prompt, completion = (x if isinstance(x, Value) else Value(x) for x in (prompt, completion))
        return function(prompt, completion, **columns)

    reward.takes_values = True
    return reward


@typed
def think_format_reward(prompt: Value, completion: Value, **_: Column) -> Column:
    return rewards.think_format(completion.text())


def helpfulness_reward(
    name: str,
    factory: models.Factory,
    model_id: str = rewards.DEFAULT_REWARD_MODEL,
    style: str = "auto",
    batch_size: int = models.REWARD_BATCH,
) -> RewardFunction:
    """The score a reward model gives to the answer without its think blocks."""

    @typed
    def reward(prompt: Value, completion: Value, **_: Column) -> Column:
        resolved = rewards.reward_model_format(F.lit(model_id), F.lit(style))
        asked = rewards.reward_model_messages(prompt.user_text(), completion.answer(), resolved)
        return rewards.last_logit(models.reward_logits(name, factory, asked, batch_size))

    return reward


def list_reward(
    name: str, factory: Callable[[], ListFunction], batch_size: int = models.LIST_BATCH
) -> RewardFunction:
    """A reward function over lists, built once per Python worker by its factory.

    It gets ``prompts``, ``completions`` and, by name, each of the columns that ``with_reward`` hands
    out, as lists of equal length. Message lists arrive as lists of dictionaries. It must return a
    number for each completion; another count, or a score that is no number, fails the job.
    """

    @typed
    def reward(prompt: Value, completion: Value, **columns: Column) -> Column:
        taken = {"prompts", "completions"} & set(columns)
        if taken:
            raise ValueError(f"columns cannot be named {sorted(taken)} for a reward over lists")
        given = {"prompts": prompt.column, "completions": completion.column, **columns}
        return models.call_lists(name, factory, given, batch_size)

    return reward


def _is_over_lists(function: Callable) -> bool:
    try:
        return {"prompts", "completions"} <= set(inspect.signature(function).parameters)
    except (TypeError, ValueError):
        return False


def _itself(function: ListFunction) -> ListFunction:
    return function


def _as_reward(function: Callable) -> RewardFunction:
    """Functions with parameters ``prompts`` and ``completions`` are ones over lists."""
    if not _is_over_lists(function):
        return function
    return list_reward(getattr(function, "__qualname__", "reward"), partial(_itself, function))


REWARDS: dict[str, RewardFunction] = {"think_format_reward": think_format_reward}


def load_rewards(
    names: Sequence[str | RewardFunction],
    weights: Sequence[float] = (),
    known: Mapping[str, RewardFunction] = REWARDS,
) -> list[tuple[RewardFunction, float]]:
    """Reward functions by name or dotted path, with weights that default to 1.

    Functions with parameters ``prompts`` and ``completions`` are called with lists.
    """
    if weights and len(weights) != len(names):
        raise ValueError("there must be one weight per reward function")
    found = [_as_reward(n if callable(n) else find(n, dict(known))) for n in names]
    return list(zip(found, map(float, weights or [1.0] * len(found))))


def with_reward(
    df: DataFrame,
    functions: Sequence[tuple[RewardFunction, float]],
    prompt: str = "prompt",
    completion: str = "completion",
    columns: Sequence[str] = (),
) -> DataFrame:
    """Add ``reward_1`` … ``reward_n`` and their weighted sum ``reward``.

    ``columns`` are handed to every function by name.
    """
    extra = {name: F.col(name) for name in columns}
    values = Value.of(df, prompt), Value.of(df, completion)

    def scored_by(function: RewardFunction) -> Column:
        given = values if getattr(function, "takes_values", False) else (v.column for v in values)
        return function(*given, **extra).cast("double")

    names = [f"reward_{i}" for i in range(1, len(functions) + 1)]
    scored = df.withColumns(
        {
            name: scored_by(function) for name, (function, _) in zip(names, functions)
        }
    )
    weighed = [F.col(name) * F.lit(weight) for name, (_, weight) in zip(names, functions)]
    return scored.withColumn("reward", reduce(lambda a, b: a + b, weighed, F.lit(0.0)))
