"""Scoring rubrics: built-in ones, files, and the lookup table for many at once."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.session import local_table


@dataclass(frozen=True)
class Category:
    key: str
    weight: float | int
    instruction: str


@dataclass(frozen=True)
class Rubric:
    categories: tuple[Category, ...]
    judge_instructions: str
    scale_min: float | int = 0
    scale_max: float | int = 5
    version: str = "v1"

    @property
    def keys(self) -> list[str]:
        return [c.key for c in self.categories]

    @property
    def total_weight(self) -> float:
        return float(sum(c.weight for c in self.categories))

    def to_json(self) -> str:
        body = {
            "version": self.version,
            "scale": {"min": self.scale_min, "max": self.scale_max},
            "categories": [asdict(c) for c in self.categories],
            "judge_instructions": self.judge_instructions,
        }
        return json.dumps(body)

    @classmethod
    def from_json(cls, text: str) -> Rubric:
        body = json.loads(text)
        return cls(
            tuple(Category(c["key"], c["weight"], c["instruction"]) for c in body["categories"]),
            body["judge_instructions"],
            body["scale"]["min"],
            body["scale"]["max"],
            body.get("version", "v1"),
        )


# Category texts and weights of the shipped rubrics.
_GENERAL_CATEGORIES = (
    Category(
        "format_compliance",
        1.0,
        "Does the answer follow required output format (e.g., <think>...</think> then final answer)?",
    ),
    Category(
        "helpfulness",
        1.0,
        "Is the response relevant, useful, and appropriately scoped to the user query?",
    ),
    Category(
        "correctness",
        1.2,
        "Is the content factually/mathematically correct given the question?",
    ),
    Category(
        "reasoning_quality",
        1.0,
        "Is the reasoning coherent, step-by-step, and free of leaps?",
    ),
    Category(
        "style_clarity",
        0.6,
        "Is the writing clear, concise, and easy to follow?",
    ),
    Category(
        "safety",
        0.2,
        "Does the response avoid unsafe, biased, or disallowed content?",
    ),
)

# Used when no rubric is named.
BUILT_IN = Rubric(
    _GENERAL_CATEGORIES,
    "You are a strict, fair LLM judge. Score each category from 0 to 5. "
    "Return a single JSON object with the shape:\n"
    "{\n"
    '  "scores": {"format_compliance": int, "helpfulness": int, ...},\n'
    '  "reasons": {"format_compliance": "why", ...}\n'
    "}\n"
    "Do not include extra keys. Do not add commentary outside JSON.\n"
    "Be concise but specific in reasons. Consider only the given prompt and answer.",
)

# The same categories with a shorter text.
GENERAL = Rubric(
    _GENERAL_CATEGORIES,
    "You are a strict, fair LLM judge. Score each category from 0 to 5 and return ONLY a JSON "
    'object: {"scores": {...}, "reasons": {...}}. Be concise but specific. Consider only the '
    "given prompt and answer.",
)

FORMAT_STYLE = Rubric(
    (
        Category(
            "format_compliance",
            1.5,
            "Does the response strictly follow the specified output format and markers?",
        ),
        Category("style_clarity", 1.2, "Is the writing organized, concise, and readable?"),
        Category("helpfulness", 1.0, "Is the content relevant and practically useful?"),
        Category("correctness", 0.8, "Is the content accurate given the prompt?"),
        Category("reasoning_quality", 0.8, "Is the reasoning step-by-step and justified?"),
        Category("safety", 0.2, "Avoid unsafe or disallowed content."),
    ),
    "Return ONLY JSON with keys 'scores' and 'reasons'. Penalize any deviation from required "
    "formatting heavily.",
)

MATH_REASONING = Rubric(
    (
        Category(
            "correctness",
            1.6,
            "Are final results and intermediate claims mathematically correct?",
        ),
        Category(
            "reasoning_quality",
            1.4,
            "Is the reasoning rigorous, logically consistent, and free of gaps?",
        ),
        Category(
            "format_compliance",
            0.8,
            "Does the answer follow the required format (e.g., <think>...</think> then final answer)?",
        ),
        Category(
            "helpfulness",
            0.8,
            "Addresses the exact question and explains choices/assumptions.",
        ),
        Category("style_clarity", 0.4, "Clear and legible derivations/notation."),
        Category("safety", 0.2, "No unsafe/disallowed content."),
    ),
    "Be strict about mathematical accuracy and logical validity. Output ONLY a JSON object with "
    "'scores' and 'reasons'.",
)

SHIPPED = {"general": GENERAL, "format_style": FORMAT_STYLE, "math_reasoning": MATH_REASONING}

RUBRIC_ROW = T.StructType(
    [
        T.StructField("rubric_id", T.StringType()),
        T.StructField("scale_min", T.DoubleType()),
        T.StructField("scale_max", T.DoubleType()),
        T.StructField(
            "categories",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("key", T.StringType()),
                        T.StructField("weight", T.DoubleType()),
                        T.StructField("instruction", T.StringType()),
                    ]
                )
            ),
        ),
    ]
)


def load_rubric(spark: SparkSession, path: str | None = None) -> Rubric:
    """The rubric of one JSON file on any file system Spark reads, or the built-in one."""
    if path is None:
        return BUILT_IN
    files = spark.read.text(path, wholetext=True).limit(2).collect()
    if len(files) != 1:
        raise ValueError(f"expected one rubric file at {path}")
    return Rubric.from_json(files[0].value)


RUBRIC_FILE = T.StructType(
    [
        T.StructField("version", T.StringType()),
        T.StructField("scale", T.StructType([T.StructField("min", T.DoubleType()), T.StructField("max", T.DoubleType())])),
        T.StructField("categories", RUBRIC_ROW["categories"].dataType),
        T.StructField("judge_instructions", T.StringType()),
    ]
)


def read_rubrics(spark: SparkSession, path: str, named: str = r"([^/]+?)(?:\.[^./]*)?$") -> DataFrame:
    """One row per JSON rubric file under a path: id, scale, categories.

    ``named`` finds the id in a file's path; by default it is the file's name without its ending.
    """
    files = spark.read.schema(RUBRIC_FILE).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), named, 1).alias("rubric_id"),
        F.col("scale.min").alias("scale_min"),
        F.col("scale.max").alias("scale_max"),
        "categories",
    )


def rubric_table(spark: SparkSession, rubrics: dict[str, Rubric]) -> DataFrame:
    """One row per rubric, to join by ``rubric_id``. Small by construction."""
    rows = [
        {
            "rubric_id": name,
            "scale_min": float(r.scale_min),
            "scale_max": float(r.scale_max),
            "categories": [
                {"key": c.key, "weight": float(c.weight), "instruction": c.instruction}
                for c in r.categories
            ],
        }
        for name, r in rubrics.items()
    ]
    return local_table(spark, rows, RUBRIC_ROW)
