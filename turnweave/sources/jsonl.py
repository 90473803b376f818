"""JSON Lines scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.schemas import CHAT_EXAMPLE

CORRUPT_COLUMN = "_corrupt_record"


def read_jsonl(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = CHAT_EXAMPLE,
    quarantine: bool = False,
) -> DataFrame:
    """Rows of JSON Lines files; blank lines are skipped.

    A malformed line fails the job. With ``quarantine`` it is kept as a row whose
    ``_corrupt_record`` holds the line.
    """
    reader = spark.read.option("encoding", "UTF-8")
    if not quarantine:
        return reader.schema(schema).option("mode", "FAILFAST").json(path)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT_COLUMN, T.StringType())])
    return (
        reader.schema(kept)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .json(path)
    )


def read_transformed(
    spark: SparkSession,
    path: str | list[str],
    transform: Callable[[DataFrame], DataFrame],
    schema: T.StructType = CHAT_EXAMPLE,
    drop: tuple[str, ...] = ("messages",),
) -> DataFrame:
    """Scan, reshape each row, drop the raw columns."""
    return read_jsonl(spark, path, schema).transform(transform).drop(*drop)


def read_preferences(
    spark: SparkSession,
    path: str | list[str],
    prompt: str = "instruction",
    chosen: str = "chosen_response",
    rejected: str = "rejected_response",
    carry: tuple[T.StructField, ...] = (),
) -> DataFrame:
    """Preference pairs under the names ``prompt``, ``chosen``, ``rejected``."""
    fields = [T.StructField(name, T.StringType()) for name in (prompt, chosen, rejected)]
    rows = read_jsonl(spark, path, T.StructType([*carry, *fields]))
    return rows.select(
        *[field.name for field in carry],
        F.col(prompt).alias("prompt"),
        F.col(chosen).alias("chosen"),
        F.col(rejected).alias("rejected"),
    )
