"""Rewards relative to the other completions of the same prompt."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.session import broadcast_if_small

# Groups with more rows are met in slices of this size.
SLICE_ROWS = 1_000_000


def group_advantage(
    rollouts: DataFrame,
    group: str,
    row: tuple[str, ...],
    reward: str = "reward",
    scale: bool = True,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add ``advantage``: reward minus group mean, over the group's standard deviation.

    It is 0 where all rewards of a group agree. ``scale=False`` leaves out the division
    (the Dr. GRPO loss). ``row`` names columns that tell a group's rows apart.

    Mean and deviation are aggregated with partial results and joined back. A group of
    more than ``slice_rows`` rows is joined in slices, against copies of its one row of
    statistics. With N rows there are at most N / ``slice_rows`` such groups, which is
    what the list of them that is sent to the executors is bounded by.
    """
    statistics = rollouts.groupBy(group).agg(
        F.avg(reward).alias("_mean"),
        F.stddev_pop(reward).alias("_std"),
        F.ceil(F.count(F.lit(1)) / F.lit(slice_rows)).cast("bigint").alias("_slices"),
    )
    large = statistics.where("_slices > 1").select(F.col(group).alias("_hot"), F.col("_slices").alias("_large"))
    copies = statistics.select(
        F.col(group).alias("_group"),
        "_mean",
        "_std",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1)).alias("_copy"),
    )
    sliced = (
        rollouts.join(broadcast_if_small(large), F.col(group).eqNullSafe(F.col("_hot")), "left")
        .withColumn("_slice", F.pmod(F.xxhash64(*row), F.coalesce("_large", F.lit(1))))
        .drop("_hot", "_large")
    )
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_slice") == F.col("_copy"))
    distance = F.col(reward) - F.col("_mean")
    advantage = distance
    if scale:
        advantage = F.coalesce(F.try_divide(distance, F.nullif("_std", F.lit(0.0))), F.lit(0.0))
    return (
        sliced.join(copies, same)
        .withColumn("advantage", advantage)
        .drop("_slice", "_copy", "_group", "_mean", "_std")
    )
