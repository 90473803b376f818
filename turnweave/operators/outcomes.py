"""What run logs say about runs. Works on batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Texts in the logs.
SAVED = "Model successfully saved to"
WATCHER = "[WATCHER]"
NOISE = "Caching is incompatible with gradient checkpointing"


def saved_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that report a saved model, except the watcher's own echo."""
    text = F.col(value)
    return lines.where(~text.startswith(WATCHER) & text.contains(SAVED))


def without_noise(lines: DataFrame, value: str = "value") -> DataFrame:
    return lines.where(~F.col(value).contains(NOISE))


def finished_runs(lines: DataFrame, run: str = "run_id", order: str = "line_no") -> DataFrame:
    """Each finished run with its first line that says so. Batch only."""
    return (
        saved_lines(lines)
        .groupBy(run)
        .agg(F.min_by(F.struct(order, "value"), order).alias("_first"))
        .select(run, f"_first.{order}", "_first.value")
    )


def run_outcomes(runs: DataFrame, finished: DataFrame, run: str = "run_id") -> DataFrame:
    """Runs, one row each, with ``success`` or ``failure``."""
    done = finished.select(run).distinct().withColumn("_done", F.lit(True))
    return runs.join(done, run, "left").select(
        *runs.columns,
        F.when(F.col("_done"), F.lit("success")).otherwise(F.lit("failure")).alias("outcome"),
    )
