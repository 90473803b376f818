"""Aggregates over judge results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnweave.functions import decisions
from turnweave.functions.judging import weighted_mean
from turnweave.session import broadcast_if_small
from turnweave.sources.rubrics import Rubric


def category_means(results: DataFrame, rubric: Rubric, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per run: the mean of each category, the sample count, and how many
    replies gave no score at all.

    Unread scores are left out of a mean; a category with none at all has mean 0.
    Rubric keys are known when the plan is made, so this is a single aggregation whose
    partial results are a few numbers per run, however large one run is.
    """
    means = [
        F.coalesce(F.avg(F.col("scores")[key]), F.lit(0.0)).alias(f"_mean_{i}")
        for i, key in enumerate(rubric.keys)
    ]
    unread = F.forall(F.map_values("scores"), lambda v: v.isNull())
    return results.groupBy(*by).agg(
        *means, F.count(F.lit(1)).alias("n"), F.count_if(unread).alias("parse_failed")
    )


def partial_sums(results: DataFrame, rubric: Rubric, by: tuple[str, ...] = ()) -> DataFrame:
    """One row per run that can be added to others: sum and count of each category's scores, the number of
    samples and of those without any score."""
    parts = []
    for i, key in enumerate(rubric.keys):
        score = F.col("scores")[key]
        parts += [F.coalesce(F.sum(score), F.lit(0.0)).alias(f"sum_{i}"), F.count(score).alias(f"count_{i}")]
    unread = F.forall(F.map_values("scores"), lambda v: v.isNull())
    return results.groupBy(*by).agg(*parts, F.count(F.lit(1)).alias("n"), F.count_if(unread).alias("parse_failed"))


def merged_means(partials: DataFrame, rubric: Rubric, by: tuple[str, ...] = ()) -> DataFrame:
    """What ``category_means`` gives for all results whose partial sums these are."""
    means = []
    for i in range(len(rubric.keys)):
        total, count = F.sum(f"sum_{i}"), F.sum(f"count_{i}")
        means.append(F.when(count > 0, total / count).otherwise(F.lit(0.0)).alias(f"_mean_{i}"))
    counts = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in ("n", "parse_failed")]
    return partials.groupBy(*by).agg(*means, *counts)


def summarize(results: DataFrame, rubric: Rubric, by: tuple[str, ...] = ()) -> DataFrame:
    """The summary of each run, with advice and the next algorithm.

    ``overall_mean`` weighs the category means; it is not the mean of ``overall``.
    Without ``by`` there is one row, also for no input.
    """
    return summary_of_means(category_means(results, rubric, by), rubric, by)


def summary_of_means(means: DataFrame, rubric: Rubric, by: tuple[str, ...] = ()) -> DataFrame:
    named = {key: F.col(f"_mean_{i}") for i, key in enumerate(rubric.keys)}
    entries = [part for key, mean in named.items() for part in (F.lit(key), mean)]
    return (
        means.withColumns(
            {
                "category_means": F.create_map(*entries),
                "overall_mean": weighted_mean(named, rubric),
            }
        )
        .withColumn("_next", decisions.next_algorithm(F.col("category_means")))
        .select(
            *by,
            "category_means",
            "overall_mean",
            "n",
            decisions.suggestions(F.col("category_means")).alias("suggestions"),
            decisions.algorithm_choices().alias("algorithm_choices"),
            F.col("_next.name").alias("next_algorithm"),
            F.col("_next.index").alias("next_algorithm_index"),
            F.col("_next.reason").alias("decision_reason"),
            "parse_failed",
        )
    )


def category_means_by_rubric(scored: DataFrame, rubrics: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Means per ``by`` and category, when every row names its own rubric.

    ``scored`` has ``rubric_id`` and ``scores``; rows meet the weights of their rubric.
    """
    weighed = scored.join(broadcast_if_small(rubrics), "rubric_id").select(
        *by, "scores", F.explode("categories").alias("category")
    )
    return (
        weighed.withColumn("score", F.col("scores")[F.col("category.key")])
        .groupBy(*by, F.col("category.key").alias("key"), F.col("category.weight").alias("weight"))
        .agg(F.coalesce(F.avg("score"), F.lit(0.0)).alias("mean"), F.count("score").alias("scored"))
    )


def overall_mean_by_rubric(means: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """The weighted mean of the category means of :func:`category_means_by_rubric`."""
    weight = F.sum("weight")
    return means.groupBy(*by).agg(
        F.when(weight == 0, F.lit(0.0))
        .otherwise(F.sum(F.col("mean") * F.col("weight")) / weight)
        .alias("overall_mean")
    )
