"""Judge requests, replies, and summaries."""

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import types as T

from turnweave.catalog import fixtures as fx
from turnweave.catalog import stubs
from turnweave.catalog.registry import query
from turnweave.functions import decisions, judging, text
from turnweave.operators import models
from turnweave.operators.ids import dense_ids, zip_by_id
from turnweave.operators.summary import (
    category_means,
    category_means_by_rubric,
    overall_mean_by_rubric,
    summarize,
)
from turnweave.plans.evaluation import evaluate
from turnweave.session import broadcast_if_small, local_table, materialize, shared_folder
from turnweave.sources.rubrics import BUILT_IN, GENERAL, SHIPPED, Category, Rubric, read_rubrics, rubric_table
from turnweave.sources.single_file import write_predictions_file
from turnweave.streaming.summaries import add_batch, keep_summary, kept_summary

WEIGHTS = fx.weights_of()
TEXT = T.StructType([T.StructField("value", T.StringType())])
SCORES = f"({fx.sql_scores()})"
QUESTION = "'PROMPT:' || chr(10) || prompt || chr(10) || chr(10) || 'ANSWER:' || chr(10) || completion"
RUBRIC_OF_ROW = """CASE conv_id % 4 WHEN 0 THEN 'general' WHEN 1 THEN 'format_style'
  WHEN 2 THEN 'math_reasoning' ELSE 'ten_point' END"""

TEN_POINT = Rubric(
    (
        Category("correctness", 2.0, "Is the answer right?"),
        Category(fx.EXTRA_KEY, 1.0, "Does the answer go to the bottom of the question?"),
    ),
    "Score each category from 1 to 10.",
    scale_min=1,
    scale_max=10,
)
RUBRICS = SHIPPED | {"ten_point": TEN_POINT}


def sql_rubrics() -> str:
    rows = [
        f"('{name}', {i}::INT, '{c.key}', {c.weight}::DOUBLE, {r.scale_min}::DOUBLE, {r.scale_max}::DOUBLE)"
        for name, r in RUBRICS.items()
        for i, c in enumerate(r.categories)
    ]
    return f"(VALUES {', '.join(rows)}) r(rubric_id, pos, key, weight, low, high)"


def _rubric_files(spark):
    """Every rubric written to a file of its own folder and read again."""
    folder = shared_folder(spark, "rubrics")
    for name, rubric in RUBRICS.items():
        local_table(spark, [{"value": rubric.to_json()}], TEXT).coalesce(1).write.text(f"{folder}/{name}")
    return read_rubrics(spark, f"{folder}/*", r"/([^/]+)/[^/]+$")


@query(
    f"""SELECT rubric_id, pos, key, weight, count(*) AS n_samples
FROM (SELECT {RUBRIC_OF_ROW} AS rubric_id FROM conversations WHERE role = 'assistant')
JOIN {sql_rubrics()} USING (rubric_id) GROUP BY ALL"""
)
def rubric_scan(spark, sf_dir):
    wanted = fx.replies(spark, sf_dir).select(F.expr(RUBRIC_OF_ROW).alias("rubric_id"))
    counted = wanted.groupBy("rubric_id").agg(F.count(F.lit(1)).alias("n_samples"))
    rubrics = broadcast_if_small(_rubric_files(spark))
    return counted.join(rubrics, "rubric_id").select(
        "rubric_id", F.posexplode("categories").alias("pos", "category"), "n_samples"
    ).select("rubric_id", "pos", "category.key", "category.weight", "n_samples")


def _request_sql(instructions: str) -> str:
    return f"SELECT conv_id, turn, {fx.sql_text(instructions)} AS system, {QUESTION} AS question FROM ({fx.SQL_ANSWERED})"


def _request(spark, sf_dir, rubric, local):
    messages = judging.judge_messages(F.col("prompt"), F.col("completion"), rubric, local)
    return fx.answered(spark, sf_dir).select("conv_id", "turn", messages.alias("m")).select(
        "conv_id",
        "turn",
        F.col("m")[0]["content"].alias("system"),
        F.col("m")[1]["content"].alias("question"),
    )


# The lines of a rubric's categories in a request.
CATEGORY_LINES = """Categories:
- format_compliance (1.0): Does the answer follow required output format (e.g., <think>...</think> then final answer)?
- helpfulness (1.0): Is the response relevant, useful, and appropriately scoped to the user query?
- correctness (1.2): Is the content factually/mathematically correct given the question?
- reasoning_quality (1.0): Is the reasoning coherent, step-by-step, and free of leaps?
- style_clarity (0.6): Is the writing clear, concise, and easy to follow?
- safety (0.2): Does the response avoid unsafe, biased, or disallowed content?
Use scale 0-5."""


@query(_request_sql(GENERAL.judge_instructions + "\n" + CATEGORY_LINES))
def judge_request(spark, sf_dir):
    return _request(spark, sf_dir, GENERAL, local=False)


@query(_request_sql(judging.LOCAL_PREAMBLE + "\n" + CATEGORY_LINES))
def judge_request_local(spark, sf_dir):
    return _request(spark, sf_dir, GENERAL, local=True)


@query(
    f"""SELECT conv_id, turn, {fx.sql_text(judging.LOCAL_PREAMBLE + chr(10) + CATEGORY_LINES)} || chr(10)
  || chr(10) || {QUESTION} || chr(10) || chr(10) || 'Return ONLY the JSON.' AS request
FROM ({fx.SQL_ANSWERED})"""
)
def judge_request_text(spark, sf_dir):
    request = judging.judge_text(F.col("prompt"), F.col("completion"), GENERAL).alias("request")
    return fx.answered(spark, sf_dir).select("conv_id", "turn", request)


@query(
    rf"""SELECT conv_id, turn, regexp_extract(raw, '\{{[\s\S]*\}}') AS json FROM ({fx.SQL_REPLIES})"""
)
def judge_extract_json(spark, sf_dir):
    found = text.isolate_json(F.col("raw")).alias("json")
    return fx.replies(spark, sf_dir).select("conv_id", "turn", found)


def _results(spark, sf_dir, rubric=BUILT_IN):
    return judging.read_replies(fx.replies(spark, sf_dir), rubric)


@query(f"SELECT conv_id, turn, {', '.join(f's_{k} AS {k}' for k in fx.KEYS)} FROM {SCORES}")
def judge_scores(spark, sf_dir):
    scores = [F.col("scores")[key].alias(key) for key in fx.KEYS]
    return _results(spark, sf_dir).select("conv_id", "turn", *scores)


@query(
    f"""SELECT conv_id, turn, coalesce(CASE WHEN json_valid(j)
    AND json_type(j, '$.reasons.helpfulness') = 'VARCHAR'
  THEN trim(json_extract_string(j, '$.reasons.helpfulness')) END, '') AS helpfulness, '' AS others
FROM {SCORES}"""
)
def judge_reasons(spark, sf_dir):
    others = [F.col("reasons")[key] for key in fx.KEYS if key != "helpfulness"]
    return _results(spark, sf_dir).select(
        "conv_id",
        "turn",
        F.col("reasons")["helpfulness"].alias("helpfulness"),
        F.concat(*others).alias("others"),
    )


SQL_OVERALL = fx.sql_weighted({k: f"s_{k}" for k in fx.KEYS}, WEIGHTS)


@query(f"SELECT conv_id, turn, round({SQL_OVERALL}, 6) + 0.0 AS overall FROM {SCORES}")
def judge_overall(spark, sf_dir):
    overall = fx.rounded(F.col("overall")).alias("overall")
    return _results(spark, sf_dir).select("conv_id", "turn", overall)


ALL_KEYS = (*fx.KEYS, fx.EXTRA_KEY)
SQL_LONG = f"""SELECT conv_id, turn, rubric_id, key, weight,
  CASE WHEN score IS NOT NULL THEN greatest(low, least(high, score)) END AS score
FROM (SELECT conv_id, turn, {RUBRIC_OF_ROW} AS rubric_id, u.key, u.score
  FROM ({fx.sql_scores(low=-1e9, high=1e9, keys=ALL_KEYS)}), LATERAL (VALUES {', '.join(f"('{k}', s_{k})" for k in ALL_KEYS)}) u(key, score))
JOIN {sql_rubrics()} USING (rubric_id, key)"""


@query(
    f"""SELECT conv_id, turn, rubric_id,
  round(sum(coalesce(score, 0.0) * weight) / sum(weight), 6) + 0.0 AS overall
FROM ({SQL_LONG}) GROUP BY conv_id, turn, rubric_id"""
)
def judge_overall_by_rubric(spark, sf_dir):
    scored = _by_rubric(spark, sf_dir)
    return scored.select("conv_id", "turn", "rubric_id", fx.rounded(F.col("overall")).alias("overall"))


def _by_rubric(spark, sf_dir):
    named = fx.replies(spark, sf_dir).withColumn("rubric_id", F.expr(RUBRIC_OF_ROW))
    return judging.read_replies_by_rubric(named, rubric_table(spark, RUBRICS))


SQL_KEY_MEANS = f"""SELECT rubric_id, key, weight, coalesce(avg(score), 0.0) AS mean,
  count(score) AS scored
FROM ({SQL_LONG}) GROUP BY rubric_id, key, weight"""


def _means_by_rubric(spark, sf_dir):
    return category_means_by_rubric(_by_rubric(spark, sf_dir), rubric_table(spark, RUBRICS), ("rubric_id",))


@query(f"SELECT rubric_id, key, weight, round(mean, 6) + 0.0 AS mean, scored FROM ({SQL_KEY_MEANS})")
def judge_means_by_rubric(spark, sf_dir):
    means = _means_by_rubric(spark, sf_dir)
    return means.withColumn("mean", fx.rounded(F.col("mean")))


@query(
    f"""SELECT rubric_id, round(sum(mean * weight) / sum(weight), 6) + 0.0 AS overall_mean
FROM ({SQL_KEY_MEANS}) GROUP BY rubric_id"""
)
def judge_overall_mean_by_rubric(spark, sf_dir):
    overall = overall_mean_by_rubric(_means_by_rubric(spark, sf_dir), ("rubric_id",))
    return overall.withColumn("overall_mean", fx.rounded(F.col("overall_mean")))


SQL_UNREAD = " AND ".join(f"s_{k} IS NULL" for k in fx.KEYS)
SQL_MEANS = ", ".join(f"coalesce(avg(s_{k}), 0.0) AS {k}" for k in fx.KEYS)


@query(
    f"""SELECT {', '.join(f'round({k}, 6) + 0.0 AS {k}' for k in fx.KEYS)}, n, parse_failed FROM (
  SELECT {SQL_MEANS}, count(*) AS n, count(*) FILTER ({SQL_UNREAD}) AS parse_failed FROM {SCORES})"""
)
def judge_category_means(spark, sf_dir):
    means = category_means(_results(spark, sf_dir), BUILT_IN)
    named = [fx.rounded(F.col(f"_mean_{i}")).alias(k) for i, k in enumerate(fx.KEYS)]
    return means.select(*named, "n", "parse_failed")


def _sql_summary(run: str, source: str) -> str:
    f = {k: f"{k}" for k in fx.KEYS}
    advice = [
        ("format_compliance < 3.5", decisions.FORMAT_ADVICE),
        ("style_clarity < 3.5 AND helpfulness >= 3.5", decisions.STYLE_ADVICE),
        ("correctness < 3.2 OR reasoning_quality < 3.2", decisions.REASONING_ADVICE),
        ("helpfulness < 3.2 AND format_compliance >= 3.5", decisions.HELPFUL_ADVICE),
        ("safety < 4.0", decisions.SAFETY_ADVICE),
    ]
    joined = ", ".join(f"CASE WHEN {test} THEN {fx.sql_text(said)} END" for test, said in advice)
    reason = f"""CASE WHEN format_compliance < 3.5 THEN '{decisions.FORMAT_REASON}'
    WHEN correctness < 3.2 OR reasoning_quality < 3.2 THEN '{decisions.REASONING_REASON}'
    WHEN helpfulness < 3.2 AND format_compliance >= 3.5 THEN '{decisions.HELPFUL_REASON}'
    WHEN style_clarity < 3.5 THEN '{decisions.STYLE_REASON}'
    WHEN safety < 4.0 THEN '{decisions.SAFETY_REASON}'
    ELSE '{decisions.DEFAULT_REASON}' END"""
    return f"""SELECT run, {', '.join(f'round({k}, 6) + 0.0 AS {k}' for k in fx.KEYS)},
  round({fx.sql_weighted(f, WEIGHTS)}, 6) + 0.0 AS overall_mean, n, parse_failed,
  concat_ws('|', {joined}) AS suggestions, 'SFT,GRPO,DPO' AS choices,
  CASE decision_reason WHEN '{decisions.REASONING_REASON}' THEN 'GRPO'
    WHEN '{decisions.HELPFUL_REASON}' THEN 'DPO' ELSE 'SFT' END AS next_algorithm,
  CASE decision_reason WHEN '{decisions.REASONING_REASON}' THEN 1
    WHEN '{decisions.HELPFUL_REASON}' THEN 2 ELSE 0 END::INT AS next_algorithm_index,
  decision_reason
FROM (SELECT *, {reason} AS decision_reason FROM (
  SELECT {run} AS run, {SQL_MEANS}, count(*) AS n,
    count(*) FILTER ({SQL_UNREAD}) AS parse_failed FROM {source} GROUP BY run))"""


def _flat_summary(summary):
    return summary.select(
        "run",
        *[fx.rounded(F.col("category_means")[k]).alias(k) for k in fx.KEYS],
        fx.rounded(F.col("overall_mean")).alias("overall_mean"),
        "n",
        "parse_failed",
        F.array_join("suggestions", "|").alias("suggestions"),
        F.array_join("algorithm_choices", ",").alias("choices"),
        "next_algorithm",
        "next_algorithm_index",
        "decision_reason",
    )


@query(_sql_summary("conv_id % 4", SCORES))
def judge_summary(spark, sf_dir):
    results = _results(spark, sf_dir).withColumn("run", F.expr("conv_id % 4"))
    return _flat_summary(summarize(results, BUILT_IN, ("run",)))


@query(_sql_summary("conv_id % 4", SCORES))
def judge_summary_stream(spark, sf_dir):
    """The same summary from a stream of replies in three batches, one of which is run twice."""
    folder = shared_folder(spark, "streamed-summary")
    raw = fx.replies(spark, sf_dir)

    def results(rows):
        return judging.read_replies(rows, BUILT_IN).withColumn("run", F.expr("conv_id % 4"))

    for third in range(3):
        raw.where(F.col("conv_id") % 3 == third).write.mode("append").parquet(f"{folder}/raw")
        stream = results(spark.readStream.schema(raw.schema).parquet(f"{folder}/raw"))
        keep_summary(stream, f"{folder}/sums", f"{folder}/progress", BUILT_IN, ("run",)).awaitTermination()
    # As after a failure between the batch's work and its entry in the checkpoint.
    add_batch(results(raw.where(F.col("conv_id") % 3 == 1)), 1, f"{folder}/sums", BUILT_IN, ("run",))
    return _flat_summary(kept_summary(spark, f"{folder}/sums", BUILT_IN, (T.StructField("run", T.LongType()),)))


# Replies that score a run's weak spots only, so that every decision is reached.
RAISED = """concat('{"scores":{"format_compliance":', CAST(CASE WHEN conv_id % 8 = 0 THEN 3 ELSE 4 END AS STRING),
  ',"helpfulness":', CAST(CASE WHEN conv_id % 8 IN (1, 2) THEN 3 ELSE 4 END AS STRING),
  ',"correctness":', CAST(CASE WHEN conv_id % 8 = 3 THEN 2 ELSE 4 END AS STRING),
  ',"reasoning_quality":', CAST(CASE WHEN conv_id % 8 IN (1, 4) THEN 3 ELSE 5 END AS STRING),
  ',"style_clarity":', CAST(CASE WHEN conv_id % 8 = 5 THEN 3 ELSE 4 END AS STRING),
  ',"safety":', CAST(CASE WHEN conv_id % 8 = 6 THEN 3 ELSE 4 END AS STRING), '},"reasons":{"helpfulness":"', """ + fx.JSON_TEXT + """, '"}}')"""
SQL_RAISED = f"(SELECT conv_id, turn, {RAISED} AS raw FROM conversations WHERE role = 'assistant')"


@query(_sql_summary("conv_id % 8", f"({fx.sql_scores(SQL_RAISED)})"))
def judge_decisions(spark, sf_dir):
    raised = fx.turns(spark, sf_dir).where("role = 'assistant'").select(
        "conv_id", "turn", F.expr(RAISED).alias("raw")
    )
    results = judging.read_replies(raised, BUILT_IN).withColumn("run", F.expr("conv_id % 8"))
    return _flat_summary(summarize(results, BUILT_IN, ("run",)))


@query(
    f"""SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, prompt AS query, completion
FROM ({fx.SQL_ANSWERED})"""
)
def zip_predictions(spark, sf_dir):
    """Prompts and completions as two tables by key, numbered without their texts, and zipped."""
    answered = materialize(fx.answered(spark, sf_dir), "answered")
    numbered = dense_ids(answered, "conv_id", "turn")
    queries = answered.join(numbered, ["conv_id", "turn"]).select("id", F.col("prompt").alias("query"))
    given = answered.join(numbered, ["conv_id", "turn"]).select("id", "completion")
    return zip_by_id(queries, given)


SQL_STUB_SIZE = f"length({QUESTION})"


@query(
    f"""SELECT conv_id, turn, helpfulness, reason, round({fx.sql_weighted({k: k for k in fx.KEYS}, WEIGHTS)}, 6)
  + 0.0 AS overall FROM (SELECT conv_id, turn, 'size ' || size AS reason,
  {', '.join(f"greatest(0.0, least(5.0, (size + {i * 5}) % 9 - 1))::DOUBLE AS {k}" for i, k in enumerate(fx.KEYS))}
  FROM (SELECT conv_id, turn, {SQL_STUB_SIZE} AS size FROM ({fx.SQL_ANSWERED})))"""
)
def judge_stub(spark, sf_dir):
    question = judging.judge_question(F.col("prompt"), F.col("completion"))
    reply = models.judge_question("stub-judge", stubs.judge, question, judging.judge_instructions(BUILT_IN))
    raw = fx.answered(spark, sf_dir).select("conv_id", "turn", reply.alias("raw"))
    results = judging.read_replies(materialize(raw, "replies"), BUILT_IN)
    return results.select(
        "conv_id",
        "turn",
        F.col("scores")["helpfulness"].alias("helpfulness"),
        F.col("reasons")["helpfulness"].alias("reason"),
        fx.rounded(F.col("overall")).alias("overall"),
    )


SQL_EVALUATED = f"""(SELECT *, length('PROMPT:' || chr(10) || prompt || chr(10) || chr(10) || 'ANSWER:' || chr(10)
    || '<think>' || length(prompt) || '</think>' || chr(10) || 'Re: ' || prompt) AS size
  FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)}))"""
SQL_EVALUATED_SCORES = ", ".join(
    f"greatest(0.0, least(5.0, (size + {i * 5}) % 9 - 1))::DOUBLE AS s_{k}"
    for i, k in enumerate(fx.KEYS)
)


@query(_sql_summary("0::BIGINT", f"(SELECT conv_id, {SQL_EVALUATED_SCORES} FROM {SQL_EVALUATED})"))
def judge_evaluation(spark, sf_dir):
    examples = fx.prompt_chats(spark, sf_dir).withColumn("id", F.col("conv_id"))
    _, _, summary = evaluate(
        examples, ("stub-generator", stubs.generator), ("stub-judge", stubs.judge)
    )
    return _flat_summary(summary.withColumn("run", F.lit(0).cast("bigint")))


@query(
    f"""SELECT '{{"id": ' || id || ', "query": ' || CAST(to_json(query) AS VARCHAR) || ', "completion": ' || CAST(to_json(completion) AS VARCHAR) || '}}' AS value
FROM (SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS id, prompt AS query, completion FROM ({fx.SQL_ANSWERED}))"""
)
def predictions_file(spark, sf_dir):
    """Predictions as the lines of a single file."""
    folder = shared_folder(spark, "predictions-file")
    write_predictions_file(zip_predictions(spark, sf_dir), f"{folder}/predictions.jsonl")
    return spark.read.text(f"{folder}/predictions.jsonl")
