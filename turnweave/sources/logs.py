"""Run logs as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_OF_PATH = r"([^/]+)/[^/]+$"


def stream_run_logs(
    spark: SparkSession, pattern: str, files_per_batch: int | None = None
) -> DataFrame:
    """Lines of ``{runs}/{run_id}/{chunk}`` files as ``(run_id, value)``.

    The file source sees new files, not growing ones: a log must land as rolled chunks.
    ``files_per_batch`` bounds what one micro-batch takes from a backlog.
    """
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(pattern).select(
        F.regexp_extract("_metadata.file_path", RUN_OF_PATH, 1).alias("run_id"), "value"
    )
