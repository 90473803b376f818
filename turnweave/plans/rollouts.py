"""Scored completions for on-policy training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.operators import models
from turnweave.operators.ids import with_epochs
from turnweave.operators.rewards import REWARDS, RewardFunction, load_rewards, with_reward
from turnweave.operators.transforms import transform_from_spec
from turnweave.schemas import CHAT_EXAMPLE
from turnweave.session import materialize
from turnweave.sources.jsonl import read_transformed


def scored_rollouts(
    queries: DataFrame,
    generator: tuple[str, models.Factory],
    rewards: Sequence[tuple[RewardFunction, float]],
    epochs: int = 1,
    batch_size: int = models.GENERATION_BATCH,
    columns: Sequence[str] | None = None,
    options: dict | None = None,
) -> DataFrame:
    """For every epoch a completion of each ``query``, with its rewards.

    Completions are written once, and so are the rewards computed from that table: no model is
    asked again when the result is read. Reward functions get ``columns``, by default all
    columns besides the query. ``options`` are sampling options for the generator's factory.
    """
    name, factory = generator
    columns = [c for c in queries.columns if c != "query"] if columns is None else columns
    completed = materialize(
        with_epochs(queries, epochs).withColumn(
            "completion",
            models.generate(name, models.with_options(factory, options), F.col("query"), batch_size),
        ),
        "completions",
    )
    return materialize(with_reward(completed, rewards, "query", "completion", columns), "scored")


def rollouts_from_settings(
    spark: SparkSession,
    settings: Mapping,
    generator: tuple[str, models.Factory],
    known: Mapping[str, RewardFunction] = REWARDS,
    schema=CHAT_EXAMPLE,
) -> DataFrame:
    """Scored completions as a settings mapping asks for them.

    Read are ``datasets`` (``path``, ``type`` and options of the transform; several are put
    together), ``rewards`` (``reward_funcs``, ``reward_weights``), ``num_epochs`` and ``generate``,
    the sampling options.
    """
    wanted = settings.get("rewards", {})
    functions = load_rewards(
        wanted.get("reward_funcs", []), wanted.get("reward_weights", []), known
    )
    if not settings["datasets"]:
        raise ValueError("settings name no dataset")
    parts = [
        read_transformed(spark, dataset["path"], transform_from_spec({**dataset, "ppo": True}), schema)
        for dataset in settings["datasets"]
    ]
    queries = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return scored_rollouts(
        queries, generator, functions, int(settings.get("num_epochs", 1)), options=settings.get("generate")
    )
