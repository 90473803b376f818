"""Judge evaluation from examples to summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.functions import chat, judging
from turnweave.operators import models
from turnweave.operators.ids import file_order_ids, first_of_files, first_rows
from turnweave.operators.ledger import ask_once
from turnweave.operators.summary import summarize
from turnweave.session import configure, materialize
from turnweave.sources import single_file, sinks
from turnweave.sources.jsonl import read_jsonl
from turnweave.sources.rubrics import BUILT_IN, Rubric, load_rubric


def call_partitions(spark: SparkSession, limit: int) -> int:
    """How many calls run at once after a limit."""
    return max(1, min(limit, spark.sparkContext.defaultParallelism))


def evaluate(
    examples: DataFrame,
    generator: tuple[str, models.Factory],
    judge: tuple[str, models.Factory],
    output_dir: str | None = None,
    rubric: Rubric = BUILT_IN,
    template: chat.ChatTemplate = chat.CHATML,
    limit: int | None = None,
    batch_size: int = models.GENERATION_BATCH,
    local_judge: bool = False,
    partitions: int | None = None,
    options: dict | None = None,
    mode: str = sinks.MODE,
    ledger: str | None = None,
    single_files: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(predictions, results, summary)`` for examples with ``id`` and ``messages``.

    Completions, raw replies and what was read from them are written before anything uses them, so
    neither model is asked twice when a later step is run again. ``partitions`` sets how many
    calls may run at once; by default it follows the size of the input, or, after a ``limit``, the
    number of tasks the cluster runs. ``options`` are sampling options for the generator's factory.
    What is in ``output_dir`` is replaced; with ``mode="error"`` an output that exists fails the call
    before a model is asked. With ``single_files`` each output is one file in the order of the ids, the
    summary an indented object; ``output_dir`` has to be mounted everywhere then.

    With ``ledger``, a folder, answers are kept there by model name, options and input, and only what it
    lacks is asked: an evaluation that was stopped goes on where it was. A model under a name
    that the ledger knows must be that model; ``id`` is then the only thing that tells equal prompts apart.
    """
    spark = examples.sparkSession
    judging.check_settings(spark)
    outputs = {n: f"{output_dir}/{n}" for n in ("predictions.jsonl", "judge_results.jsonl", "summary.json")}
    if output_dir is not None and mode in ("error", "errorifexists"):
        taken = [path for path in outputs.values() if not sinks.is_free(spark, path)]
        if taken:
            raise FileExistsError(f"already there: {', '.join(taken)}")
    if partitions is None and limit is not None:
        partitions = call_partitions(spark, limit)

    def spread(df: DataFrame) -> DataFrame:
        return df if partitions is None else df.repartition(partitions, "id")

    chosen = first_rows(examples, limit, "id")
    prompts = chosen.select(
        "id",
        chat.render_prompt(chat.without_assistant(F.col("messages")), template).alias("query"),
    )
    name, factory = generator
    instructions = judging.judge_instructions(rubric, local_judge)

    def complete(query: Column) -> Column:
        return models.generate(name, models.with_options(factory, options), query, batch_size)

    def reply(question: Column) -> Column:
        return models.judge_question(*judge, question, instructions)

    question = judging.judge_question(F.col("query"), F.col("completion"))
    if ledger is None:
        predictions = materialize(spread(prompts).withColumn("completion", complete(F.col("query"))), "predictions")
        raw = materialize(spread(predictions).select("id", reply(question).alias("raw")), "replies")
    else:
        kept = {"path": ledger, "partitions": partitions}
        answered = ask_once(prompts, F.col("query"), "completion", complete, name=name, options=options, **kept)
        predictions = materialize(answered, "predictions")
        judged = ask_once(predictions, question, "raw", reply, name=judge[0], options={"instructions": instructions}, **kept)
        raw = materialize(judged.select("id", "raw"), "replies")
    results = materialize(judging.read_replies(raw, rubric), "judge-results")
    summary = summarize(results, rubric)
    if output_dir is not None and single_files:
        single_file.write_predictions_file(predictions, outputs["predictions.jsonl"])
        single_file.write_judge_results_file(results, outputs["judge_results.jsonl"])
        single_file.write_summary_file(summary, outputs["summary.json"])
    elif output_dir is not None:
        sinks.write_predictions(predictions, outputs["predictions.jsonl"], mode)
        sinks.write_judge_results(results, outputs["judge_results.jsonl"], mode)
        sinks.write_summary(summary, outputs["summary.json"], mode)
    return predictions, results, summary


def evaluate_file(
    spark: SparkSession,
    data: str,
    generator: tuple[str, models.Factory],
    judge: tuple[str, models.Factory],
    output_dir: str,
    rubric_path: str | None = None,
    limit: int | None = None,
    **options,
) -> DataFrame:
    """Evaluate the examples of JSON Lines files, numbered in input order; the summary.

    With a ``limit`` only as much of the files is read as the first rows need.
    """
    configure(spark)
    examples = read_jsonl(spark, data)
    if limit is None:
        examples = file_order_ids(examples)
    else:
        files = sorted(examples.inputFiles())
        examples = first_of_files(spark, files, lambda file: read_jsonl(spark, file), limit)
        if options.get("partitions") is None:
            options["partitions"] = call_partitions(spark, limit)
    rubric = load_rubric(spark, rubric_path)
    # The limit is met: taking it again would gather all of its rows in one task.
    _, _, summary = evaluate(examples, generator, judge, output_dir, rubric, **options)
    return summary
