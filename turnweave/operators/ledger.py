"""Model answers that outlive a run.

Answers are kept in a folder of Parquet files under a digest of the model's name, its options and the
input. A run asks only what the folder does not hold, each distinct input once, and appends its
answers batch by batch: what a killed run had finished is there for the next one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.session import shared_folder
from turnweave.sources.sinks import is_free

#: Inputs asked between two commits.
BATCH_ROWS = 100_000


def model_digest(name: str, options: Mapping | None = None) -> str:
    """Tells models apart: by name and options, whatever process names them."""
    return hashlib.sha256(json.dumps([name, dict(options or {})], sort_keys=True, default=str).encode()).hexdigest()[:32]


def input_digest(value: Column) -> Column:
    """A digest of a text, or of any value that JSON can say; null differs from empty."""
    return F.sha2(F.to_json(F.struct(value.alias("v"))).cast("binary"), 256)


def kept_answers(spark: SparkSession, path: str, model: str, result: T.DataType) -> DataFrame:
    """Rows ``(digest, answer)`` of a model. Of answers that two runs gave at once the smaller one counts."""
    schema = T.StructType([T.StructField("digest", T.StringType()), T.StructField("answer", result), T.StructField("model", T.StringType())])
    if is_free(spark, path):
        return spark.createDataFrame([], schema).select("digest", "answer")
    rows = spark.read.schema(schema).parquet(path).where(F.col("model") == model)
    return rows.groupBy("digest").agg(F.min("answer").alias("answer"))


def ask_once(
    df: DataFrame,
    question: Column,
    answer: str,
    ask: Callable[[Column], Column],
    path: str,
    name: str,
    options: Mapping | None = None,
    result: T.DataType | None = None,
    batch_rows: int = BATCH_ROWS,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``answer`` to ``question``, from the ledger at ``path`` or by ``ask``.

    ``name`` and ``options`` say which answers may be used again; change either where the model changes.
    ``result`` is the type of the answers, text by default. ``partitions`` is how many calls may
    run at once. Rows of an equal question share its answer.
    """
    spark, result, model = df.sparkSession, result or T.StringType(), model_digest(name, options)
    asked = df.withColumns({"_question": question, "_digest": input_digest(question)})
    known = kept_answers(spark, path, model, result)
    todo = asked.select("_digest", "_question").dropDuplicates(["_digest"])
    todo = todo.join(known.select(F.col("digest").alias("_digest")), "_digest", "left_anti")
    # The open questions are written by batch, so that a batch reads its own ones only.
    folder = shared_folder(spark, "questions")
    size = todo.count()
    batches = -(-size // batch_rows)
    if batches:
        numbered = todo.withColumn("_batch", F.pmod(F.xxhash64("_digest"), F.lit(batches)).cast("int"))
        numbered.repartition("_batch", F.pmod(F.xxhash64("_digest", F.lit(1)), F.lit(8))).write.partitionBy("_batch").parquet(folder)
        schema = T.StructType([*todo.schema, T.StructField("_batch", T.IntegerType())])
        open_questions = spark.read.schema(schema).parquet(folder)
        for batch in range(batches):
            some = open_questions.where(F.col("_batch") == batch)
            some = some if partitions is None else some.repartition(partitions)
            answers = some.select(F.col("_digest").alias("digest"), ask(F.col("_question")).alias("answer"), F.lit(model).alias("model"))
            answers.write.mode("append").partitionBy("model").parquet(path)
    answers = kept_answers(spark, path, model, result).select(F.col("digest").alias("_digest"), F.col("answer").alias("_answer"))
    return asked.join(answers, "_digest", "left").select(*[F.col(f"`{c}`") for c in df.columns if c != answer], F.col("_answer").alias(answer))
