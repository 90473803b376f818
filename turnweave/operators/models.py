"""Model calls: generators, judges and reward models as Arrow-batched functions.

A model is given by a factory without arguments that returns a function from a list
of inputs to a list of outputs. It is built once per Python worker. Only the input
column crosses to Python. Outputs of real models differ from call to call, so write them
with :func:`turnweave.session.materialize` before using them twice.
"""

from __future__ import annotations

import hashlib
import sys
import types
from collections.abc import Callable, Iterator, Mapping
from functools import partial

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Batch = Callable[[list], list]
Factory = Callable[[], Batch]

# Defaults of sampling and batching.
GENERATION_DEFAULTS = {
    "max_new_tokens": 256,
    "do_sample": True,
    "temperature": 0.7,
    "top_p": 0.9,
    "top_k": None,
}
GENERATION_BATCH = 8
REWARD_BATCH = 2
# Rows that a reward function over lists gets at once.
LIST_BATCH = 64


def generation_options(given: dict | None = None) -> dict:
    """Sampling options with defaults filled in and unset ones left out."""
    merged = {**GENERATION_DEFAULTS, **(given or {})}
    if merged["top_k"] == "None":
        merged["top_k"] = None
    return {k: v for k, v in merged.items() if v is not None}


def with_options(factory: Callable[..., Batch], options: dict | None) -> Factory:
    """A factory that builds its model with sampling options, if any are given."""
    return factory if options is None else partial(factory, **generation_options(options))


def identity(name: str, factory: Factory) -> str:
    """The name and a digest of the factory: another factory of that name is another model."""
    return f"{name}-{hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()}"


def once_per_worker(name: str, factory: Factory) -> Batch:
    """Build a model at its first use in this Python worker and keep it."""
    # Functions arrive by value, so only sys.modules outlives a task.
    holder = sys.modules.setdefault("_turnweave_models", types.ModuleType("_turnweave_models"))
    models = holder.__dict__.setdefault("models", {})
    if name not in models:
        models[name] = factory()
    return models[name]


def _in_batches(model: Batch, inputs: list, size: int) -> list:
    outputs: list = []
    for start in range(0, len(inputs), size):
        batch = inputs[start : start + size]
        found = list(model(batch))
        if len(found) != len(batch):
            raise ValueError("a model must return one output per input")
        outputs.extend(found)
    return outputs


def call_model(
    name: str,
    factory: Factory,
    inputs: Column,
    result: T.DataType,
    batch_size: int,
    prepare: Callable[[object], object] | None = None,
) -> Column:
    """A model's outputs for a column, ``batch_size`` rows per call.

    ``prepare`` makes a model's input of a column's value, there where the model is.
    """
    size, key = max(1, batch_size), identity(name, factory)

    @F.pandas_udf(result)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = once_per_worker(key, factory)
        for batch in batches:
            values = batch.tolist() if prepare is None else [prepare(value) for value in batch]
            yield pd.Series(_in_batches(model, values, size), dtype=object)

    return call.asNondeterministic()(inputs)


def call_lists(name: str, factory: Callable[[], Callable[..., list]], columns: Mapping[str, Column], batch_size: int) -> Column:
    """Numbers that a function over lists gives to rows, ``batch_size`` rows per call.

    Each column is handed over by its name, as a list of plain values: texts, numbers, lists and
    dictionaries, or None. One finite or infinite number per row must come back.
    """
    size, key, names = max(1, batch_size), identity(name, factory), list(columns)

    @F.arrow_udf(T.DoubleType())
    def call(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        function = once_per_worker(key, factory)
        for arrays in batches:
            scores: list[float] = []
            for start in range(0, len(arrays[0]), size):
                given = {n: a.slice(start, size).to_pylist() for n, a in zip(names, arrays)}
                found = list(function(**given))
                if len(found) != len(given[names[0]]):
                    raise ValueError(f"{name} must return one score per completion")
                scores.extend(float(score) for score in found)
            yield pa.array(scores, pa.float64())

    return call.asNondeterministic()(*columns.values())


def generate(
    name: str, factory: Factory, prompt: Column, batch_size: int = GENERATION_BATCH
) -> Column:
    """Completions for prompts."""
    return call_model(name, factory, prompt, T.StringType(), batch_size)


def judge(name: str, factory: Factory, request: Column, batch_size: int = 1) -> Column:
    """Raw judge replies for request texts or request message lists."""
    return call_model(name, factory, request, T.StringType(), batch_size)


def judge_question(
    name: str, factory: Factory, question: Column, instructions: str, batch_size: int = 1
) -> Column:
    """Raw judge replies to questions under the same instructions.

    The instructions travel with the task, not with every row.
    """

    def request(text: str) -> list[dict]:
        return [{"role": "system", "content": instructions}, {"role": "user", "content": text}]

    return call_model(name, factory, question, T.StringType(), batch_size, request)


def reward_logits(
    name: str, factory: Factory, messages: Column, batch_size: int = REWARD_BATCH
) -> Column:
    """A reward model's output rows for two-message conversations."""
    return call_model(name, factory, messages, T.ArrayType(T.DoubleType()), batch_size)
