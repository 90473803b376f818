"""JSON Lines sinks. Each writes a directory of part files; what was there is replaced, unless
another mode is asked for."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.schemas import SUMMARY


MODE = "overwrite"


def is_free(spark: SparkSession, path: str) -> bool:
    """Whether nothing is at a path yet."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return True
    return False


def write_predictions(predictions: DataFrame, path: str, mode: str = MODE) -> None:
    predictions.select("id", "query", "completion").write.mode(mode).json(path)


def write_judge_results(results: DataFrame, path: str, mode: str = MODE) -> None:
    """Scores that could not be read are written as ``null``, not left out."""
    (
        results.select("scores", "reasons", "id", "overall")
        .write.mode(mode)
        .option("ignoreNullFields", "false")
        .json(path)
    )


def write_summary(summary: DataFrame, path: str, mode: str = MODE) -> None:
    """One object per run."""
    extra = [c for c in summary.columns if c not in SUMMARY.names]
    summary.select(*extra, *SUMMARY.names).write.mode(mode).json(path)


def write_examples(examples: DataFrame, path: str) -> None:
    examples.write.json(path)


def write_preferences(
    pairs: DataFrame,
    path: str,
    prompt: str = "instruction",
    chosen: str = "chosen_response",
    rejected: str = "rejected_response",
) -> None:
    renamed = pairs.select(
        *[F.col(c) for c in pairs.columns if c not in ("prompt", "chosen", "rejected")],
        F.col("prompt").alias(prompt),
        F.col("chosen").alias(chosen),
        F.col("rejected").alias(rejected),
    )
    renamed.write.json(path)
