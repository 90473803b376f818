"""Inputs of the registered queries, derived from the given tables.

Completions and judge replies are built by SQL expressions over row keys that both
engines understand, so the check runs on the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.session import configure
from turnweave.sources.rubrics import BUILT_IN
from turnweave.sources.turns import answered_turns, assemble_chats

KEYS = ("format_compliance", "helpfulness", "correctness", "reasoning_quality", "style_clarity", "safety")

COMPLETION = """CASE (conv_id + turn) % 6
  WHEN 0 THEN '<think>' || text || '</think>' || chr(10) || chr(10) || 'Answer: ' || text
  WHEN 1 THEN '<think>' || text
  WHEN 2 THEN '<think>a</think><think>b</think> ' || text
  WHEN 3 THEN '  ' || chr(10) || text
  WHEN 4 THEN '<think>' || text || '</think>  '
  ELSE text END"""


# A category that only the rubric with a scale of its own knows.
EXTRA_KEY = "depth"

# A turn's text within a JSON string.
JSON_TEXT = "text"
for _plain, _escaped in ((92, "chr(92) || chr(92)"), (34, "chr(92) || chr(34)"), (10, "chr(92) || 'n'"), (13, "chr(92) || 'r'"), (9, "chr(92) || 't'")):
    JSON_TEXT = f"replace({JSON_TEXT}, chr({_plain}), {_escaped})"


def _score(i: int) -> str:
    return f"CAST((conv_id * 7 + turn * 3 + {i * 5}) % 9 - 1 AS STRING)"


def _body(changed: dict[str, str | None] = {}) -> str:
    """A reply as a SQL expression; ``changed`` replaces values, ``None`` leaves one out."""
    values = {key: changed.get(key, _score(i)) for i, key in enumerate(KEYS)}
    values[EXTRA_KEY] = "CAST((conv_id * 5 + turn) % 14 - 1 AS STRING)"
    fields = [f"""'"{key}":' || {value}""" for key, value in values.items() if value]
    scores = " || ',' || ".join(fields)
    return (
        f"""'{{"scores":{{' || {scores} || """
        f"""'}},"reasons":{{"helpfulness":"  r' || {_score(1)} || ' ' || {JSON_TEXT} || '. "}}}}'"""
    )


REPLY = f"""CASE (conv_id * 7 + turn * 3) % 12
  WHEN 0 THEN '{{"scores":{{"format_compliance":' || {_score(0)}
  WHEN 1 THEN 'Verdict: ' || text || chr(10) || {_body()} || chr(10) || text || ' Done.'
  WHEN 2 THEN {_body({"correctness": "'" + '"4"' + "'"})}
  WHEN 3 THEN {_body({"safety": "'null'"})}
  WHEN 4 THEN {_body({"helpfulness": "'true'"})}
  WHEN 5 THEN {_body()} || ' x {{"a":1}}'
  WHEN 6 THEN 'not json at all: ' || text
  WHEN 7 THEN {_body({"style_clarity": None})}
  WHEN 8 THEN '{{"scores":[1,2]}}'
  WHEN 9 THEN {_body({"reasoning_quality": _score(3) + " || '.5'"})}
  ELSE {_body()} END"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_chats(turns(spark, sf_dir))


def prompt_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assemble_chats(turns(spark, sf_dir), prompts_only=True)


def answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return answered_turns(turns(spark, sf_dir))


def completions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        turns(spark, sf_dir)
        .where("role = 'assistant'")
        .select("conv_id", "turn", F.expr(COMPLETION).alias("completion"))
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        turns(spark, sf_dir)
        .where("role = 'assistant'")
        .select("conv_id", "turn", F.expr(REPLY).alias("raw"))
    )


def with_metadata(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "answer_key": F.expr("substr('ABCD', CAST(conv_id % 4 AS INT) + 1, 1)"),
            "source_file": F.expr("concat('chunk', conv_id % 4 + 1)"),
        }
    )


LOG_LINE = """CASE event_type
  WHEN 'purchase' THEN 'INFO Model successfully saved to /m'
  WHEN 'error' THEN '[WATCHER] Model successfully saved to x'
  WHEN 'view' THEN 'WARN Caching is incompatible with gradient checkpointing'
  ELSE 'step ' || CAST(event_id AS STRING) END"""


def log_lines(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("user_id").alias("run_id"),
        F.col("event_id").alias("line_no"),
        F.expr(LOG_LINE).alias("value"),
    )


def rounded(column) -> object:
    """Six digits, and no negative zero."""
    return F.round(column, 6) + F.lit(0.0)


# The same inputs for the other engine.

SQL_ANSWERED = """SELECT conv_id, turn, text AS prompt, next_text AS completion FROM (
  SELECT conv_id, turn, role, text,
    lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE role = 'user' AND next_role = 'assistant'"""

SQL_COMPLETIONS = f"""SELECT conv_id, turn, {COMPLETION} AS completion
FROM conversations WHERE role = 'assistant'"""

SQL_REPLIES = f"""SELECT conv_id, turn, {REPLY} AS raw
FROM conversations WHERE role = 'assistant'"""

SQL_LOG_LINES = f"""SELECT user_id AS run_id, event_id AS line_no, {LOG_LINE} AS value FROM events"""


def sql_prompts(line: str, header: str, where: str = "role <> 'assistant'") -> str:
    """Prompts of whole chats from one SQL expression for a turn's text."""
    return f"""SELECT conv_id,
    coalesce(string_agg({line}, '' ORDER BY turn) FILTER ({where}), '') || {header} AS prompt
  FROM conversations GROUP BY conv_id"""


SQL_CHATML_LINE = "'<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10)"
SQL_CHATML_HEADER = "'<|im_start|>assistant' || chr(10)"
SQL_PLAIN_LINE = "role || ': ' || text || chr(10)"
SQL_PLAIN_HEADER = "'assistant: '"


def sql_strip_think(text: str) -> str:
    space = r"[\t\n\v\f\r \x1c-\x1f]"
    return f"regexp_replace({text}, '(?s)<think>.*?</think>{space}*', '', 'g')"


def sql_normalized(text: str) -> str:
    space = r"[\t\n\v\f\r \x1c-\x1f]"
    return f"regexp_replace({sql_strip_think(text)}, '^{space}+', '')"


def sql_think_format(text: str) -> str:
    return (
        f"CASE WHEN starts_with({text}, '<think>')"
        f" AND len(str_split({text}, '<think>')) = 2"
        f" AND contains({text}, '</think>')"
        f" AND regexp_matches(substr({text}, strpos({text}, '</think>') + 8), '\\S')"
        f" THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
    )


def sql_scores(replies: str = SQL_REPLIES, low: float = 0, high: float = 5, keys: tuple[str, ...] = KEYS) -> str:
    """Rows ``(conv_id, turn, j, ok, s_<key>...)`` from replies."""

    def score(key: str) -> str:
        path = f"$.scores.{key}"
        text = f"json_extract_string(j, '{path}')"
        number = f"CASE {text} WHEN 'true' THEN 1.0 WHEN 'false' THEN 0.0 ELSE try_cast({text} AS DOUBLE) END"
        return (
            f"CASE WHEN json_valid(j) AND json_type(j, '{path}') IN"
            f" ('UBIGINT','BIGINT','DOUBLE','BOOLEAN')"
            f" THEN greatest({low}::DOUBLE, least({high}::DOUBLE, {number})) + 0.0 END::DOUBLE AS s_{key}"
        )

    scores = ",\n    ".join(score(key) for key in keys)
    return f"""SELECT *, {scores} FROM (
    SELECT *, regexp_extract(raw, '\\{{[\\s\\S]*\\}}') AS j FROM ({replies}))"""


def sql_weighted(values: dict[str, str], weights: dict[str, float]) -> str:
    total = sum(weights.values())
    parts = " + ".join(f"coalesce({values[k]}, 0.0) * {w}::DOUBLE" for k, w in weights.items())
    return f"({parts}) / {total}::DOUBLE"


def weights_of(rubric=BUILT_IN) -> dict[str, float]:
    return {c.key: float(c.weight) for c in rubric.categories}


def sql_text(text: str) -> str:
    """A string constant."""
    return "'" + text.replace("'", "''") + "'"
