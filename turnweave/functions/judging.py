"""Judge requests and the reading of judge replies."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.functions import text as tx
from turnweave.session import broadcast_if_small
from turnweave.sources.rubrics import Rubric

# Fixed values.
LOCAL_PREAMBLE = (
    "You are a strict, fair LLM judge. "
    "Score each category 0-5 and return ONLY a JSON object with keys 'scores' and 'reasons'."
)
ONLY_JSON = "Return ONLY the JSON."

NUMBER_TYPES = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT|BOOLEAN)"


def judge_instructions(rubric: Rubric, local: bool = False) -> str:
    """What the judge is told. A local judge gets a fixed preamble."""
    opening = LOCAL_PREAMBLE if local else rubric.judge_instructions
    lines = [f"- {c.key} ({c.weight}): {c.instruction}" for c in rubric.categories]
    scale = f"Use scale {rubric.scale_min}-{rubric.scale_max}."
    return "\n".join([opening, "Categories:", *lines, scale])


def judge_question(prompt: Column, completion: Column) -> Column:
    return F.concat(F.lit("PROMPT:\n"), prompt, F.lit("\n\nANSWER:\n"), completion)


def judge_messages(
    prompt: Column, completion: Column, rubric: Rubric, local: bool = False
) -> Column:
    return F.array(
        F.struct(
            F.lit("system").alias("role"), F.lit(judge_instructions(rubric, local)).alias("content")
        ),
        F.struct(F.lit("user").alias("role"), judge_question(prompt, completion).alias("content")),
    )


def judge_text(prompt: Column, completion: Column, rubric: Rubric) -> Column:
    """The request of a local judge that has no chat template."""
    return F.concat(
        F.lit(judge_instructions(rubric, local=True) + "\n\n"),
        judge_question(prompt, completion),
        F.lit("\n\n" + ONLY_JSON),
    )


def _field(parsed: Column, group: str, key: str) -> Column:
    quoted = key.replace("\\", "\\\\").replace('"', '\\"')
    return F.try_variant_get(parsed, f'$[0].{group}["{quoted}"]', "variant")


def _number(field: Column) -> Column:
    """The value of a number or boolean; null for anything else."""
    return F.when(
        F.schema_of_variant(field).rlike(NUMBER_TYPES), F.try_variant_get(field, "$", "double")
    )


def _text(field: Column) -> Column:
    return F.when(
        F.schema_of_variant(field) == F.lit("STRING"), F.try_variant_get(field, "$", "string")
    )


def clamp(value: Column, rubric: Rubric) -> Column:
    """A score within the rubric's scale, never a negative zero."""
    low, high = F.lit(float(rubric.scale_min)), F.lit(float(rubric.scale_max))
    # least/greatest skip nulls, so an unread score must not reach them.
    return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)) + F.lit(0.0))


def weighted_mean(values: dict[str, Column], rubric: Rubric) -> Column:
    """Values by category weighed by the rubric; a missing value counts 0."""
    total = rubric.total_weight
    if not total:
        return F.lit(0.0)
    parts = [
        F.coalesce(values[c.key], F.lit(0.0)) * F.lit(float(c.weight)) for c in rubric.categories
    ]
    return reduce(lambda a, b: a + b, parts, F.lit(0.0)) / F.lit(total)


def _literal_map(pairs: list[tuple[str, Column]], value_type: str) -> Column:
    if not pairs:
        return F.map_from_arrays(F.array(), F.array()).cast(f"map<string,{value_type}>")
    return F.create_map(*[part for key, value in pairs for part in (F.lit(key), value)])


def check_settings(spark: SparkSession) -> None:
    """Replies with a repeated key are only read under the setting that ``configure`` makes."""
    if spark.conf.get("spark.sql.variant.allowDuplicateKeys", "false") != "true":
        raise ValueError("call turnweave.session.configure first: replies may repeat a key")


def read_replies(df: DataFrame, rubric: Rubric, raw: str = "raw") -> DataFrame:
    """Add ``scores``, ``reasons`` and ``overall`` from the judge's raw text.

    The reply is parsed once into a variant. It is wrapped in brackets first: trailing
    text inside the braces then makes the document invalid, as it should.
    """
    check_settings(df.sparkSession)
    document = F.concat(F.lit("["), tx.isolate_json(F.col(raw)), F.lit("]"))
    one = F.size(F.try_variant_get("_reply", "$", "array<variant>")) == 1
    staged = df.withColumn("_reply", F.try_parse_json(document)).withColumn(
        "_reply", F.when(one, F.col("_reply"))
    )
    # In steps, so that no field is extracted twice.
    reply, places = F.col("_reply"), range(len(rubric.keys))
    fields = {f"_score_{i}": _field(reply, "scores", key) for i, key in enumerate(rubric.keys)}
    fields |= {f"_reason_{i}": _field(reply, "reasons", key) for i, key in enumerate(rubric.keys)}
    values = {f"_score_{i}": _number(F.col(f"_score_{i}")) for i in places}
    values |= {f"_reason_{i}": _text(F.col(f"_reason_{i}")) for i in places}
    scores = [(key, clamp(F.col(f"_score_{i}"), rubric)) for i, key in enumerate(rubric.keys)]
    reasons = [
        (key, F.coalesce(tx.strip(F.col(f"_reason_{i}")), F.lit("")))
        for i, key in enumerate(rubric.keys)
    ]
    read = (
        staged.withColumns(fields)
        .withColumns(values)
        .withColumns(
            {"scores": _literal_map(scores, "double"), "reasons": _literal_map(reasons, "string")}
        )
        .drop("_reply", *fields)
    )
    found = {key: F.col("scores")[key] for key in rubric.keys}
    return read.withColumn("overall", weighted_mean(found, rubric))


def read_replies_by_rubric(df: DataFrame, rubrics: DataFrame, raw: str = "raw") -> DataFrame:
    """As :func:`read_replies`, where each row names its rubric in ``rubric_id``.

    Keys, weights and scale are those of the row's rubric; rows that name no known one fall away.
    """
    check_settings(df.sparkSession)
    document = F.concat(F.lit("["), tx.isolate_json(F.col(raw)), F.lit("]"))
    one = F.size(F.try_variant_get("_reply", "$", "array<variant>")) == 1
    known = rubrics.select("rubric_id", *[F.col(c).alias(f"_{c}") for c in ("scale_min", "scale_max", "categories")])
    staged = df.join(broadcast_if_small(known), "rubric_id").withColumn("_reply", F.try_parse_json(document))
    staged = staged.withColumn("_reply", F.when(one, F.col("_reply"))).withColumns(
        {f"_{group}": F.try_variant_get("_reply", f"$[0].{group}", "map<string,variant>") for group in ("scores", "reasons")}
    )

    def clamped(value: Column) -> Column:
        low, high = F.col("_scale_min"), F.col("_scale_max")
        return F.when(value.isNotNull(), F.greatest(low, F.least(high, value)) + F.lit(0.0))

    keys = F.transform("_categories", lambda c: c["key"])
    scores = F.transform("_categories", lambda c: clamped(_number(F.col("_scores")[c["key"]])))
    reasons = F.transform("_categories", lambda c: F.coalesce(tx.strip(_text(F.col("_reasons")[c["key"]])), F.lit("")))
    read = staged.withColumns({"scores": F.map_from_arrays(keys, scores), "reasons": F.map_from_arrays(keys, reasons)})
    overall = overall_by_categories(F.col("scores"), F.col("_categories"))
    return read.withColumn("overall", overall).drop("_reply", "_scores", "_reasons", "_scale_min", "_scale_max", "_categories")


def overall_by_categories(scores: Column, categories: Column) -> Column:
    """Per-sample overall with the weights taken from a rubric row."""
    weights = F.aggregate(categories, F.lit(0.0), lambda a, c: a + c["weight"])
    total = F.aggregate(
        categories,
        F.lit(0.0),
        lambda a, c: a + F.coalesce(scores[c["key"]], F.lit(0.0)) * c["weight"],
    )
    return F.when(weights == 0, F.lit(0.0)).otherwise(total / weights)
