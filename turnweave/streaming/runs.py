"""Run completion from log streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from turnweave.operators.outcomes import saved_lines

SALTS = 16


def completions(
    lines: DataFrame, run: str = "run_id", time: str | None = None, within: str = "7 days"
) -> DataFrame:
    """One event per run, at the first line that reports a saved model.

    State is a row per run. Lines of one run are first reduced in up to ``SALTS``
    places, by the task that read them, so that a run that reports again and again does
    not fall on a single task.

    With ``time``, a timestamp column, a run is forgotten ``within`` that time after its
    report, and later repeats of it count anew; without, state is kept for good.
    """
    place = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("_place")
    if time is None:
        reduced = saved_lines(lines).select(run, place).dropDuplicates([run, "_place"])
        return reduced.select(run).dropDuplicates([run])
    timed = saved_lines(lines.withWatermark(time, within)).select(run, time, place)
    reduced = timed.dropDuplicatesWithinWatermark([run, "_place"])
    return reduced.select(run, time).dropDuplicatesWithinWatermark([run]).select(run)


def write_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, append it as Parquet, and stop."""
    start_sink(stream, path, checkpoint, {"availableNow": True}).awaitTermination()


def start_sink(stream: DataFrame, path: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )
