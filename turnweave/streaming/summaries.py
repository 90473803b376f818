"""Summaries of judge results that keep arriving.

Each micro-batch leaves its partial sums under its own number. A batch that is run again replaces what it left
before, so nothing counts twice, and the summary of everything so far is an addition of a few numbers per
run and batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from turnweave.operators.summary import merged_means, partial_sums, summary_of_means
from turnweave.sources.rubrics import Rubric
from turnweave.sources.sinks import is_free


def add_batch(results: DataFrame, number: int, path: str, rubric: Rubric, by: tuple[str, ...] = ()) -> None:
    """Store the partial sums of one batch, in place of those it may have stored before."""
    partial_sums(results, rubric, by).write.mode("overwrite").parquet(f"{path}/batch={number}")


def keep_summary(results: DataFrame, path: str, checkpoint: str, rubric: Rubric, by: tuple[str, ...] = (), trigger: dict | None = None) -> StreamingQuery:
    """Start a query that stores the partial sums of a stream of judge results at ``path``."""

    def store(batch: DataFrame, number: int) -> None:
        add_batch(batch, number, path, rubric, by)

    return (
        results.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def partial_schema(rubric: Rubric, keys: list[T.StructField]) -> T.StructType:
    sums = [T.StructField(f"{name}_{i}", kind) for i in range(len(rubric.keys)) for name, kind in (("sum", T.DoubleType()), ("count", T.LongType()))]
    counts = [T.StructField(name, T.LongType()) for name in ("n", "parse_failed")]
    return T.StructType([*keys, *sums, *counts, T.StructField("batch", T.LongType())])


def kept_summary(spark: SparkSession, path: str, rubric: Rubric, by: tuple[T.StructField, ...] = ()) -> DataFrame:
    """The summary of all batches stored at ``path``; ``by`` are the fields of the run's key."""
    schema, names = partial_schema(rubric, list(by)), tuple(f.name for f in by)
    partials = spark.createDataFrame([], schema) if is_free(spark, path) else spark.read.schema(schema).parquet(path)
    return summary_of_means(merged_means(partials, rubric, names), rubric, names)
