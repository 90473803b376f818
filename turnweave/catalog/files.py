"""JSON Lines files written and read again, on the shared folder."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.catalog import fixtures as fx
from turnweave.catalog import stubs
from turnweave.catalog.judging import SCORES, SQL_OVERALL, WEIGHTS
from turnweave.catalog.registry import query
from turnweave.functions import judging
from turnweave.operators.ids import file_order_ids, first_of_files
from turnweave.operators.summary import summarize
from turnweave.operators.transforms import messages_to_prompt
from turnweave.plans.rollouts import rollouts_from_settings
from turnweave.schemas import CHAT_EXAMPLE, JUDGE_RESULT, PREDICTION, SUMMARY
from turnweave.session import shared_folder
from turnweave.sources import jsonl, sinks
from turnweave.sources.rubrics import BUILT_IN

KEYED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        *CHAT_EXAMPLE.fields,
    ]
)


def _examples_file(spark, sf_dir):
    path = shared_folder(spark, "examples")
    sinks.write_examples(fx.with_metadata(fx.chats(spark, sf_dir)), path)
    return path


@query(
    f"""SELECT conv_id, string_agg(role || '=' || text, '|' ORDER BY turn) AS messages,
  substr('ABCD', CAST(conv_id % 4 AS INT) + 1, 1) AS answer_key, '' AS reference_solution
FROM conversations GROUP BY conv_id"""
)
def jsonl_roundtrip(spark, sf_dir):
    read = jsonl.read_jsonl(spark, _examples_file(spark, sf_dir), KEYED)
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return read.select(
        "conv_id",
        F.array_join(lines, "|").alias("messages"),
        "answer_key",
        F.coalesce("reference_solution", F.lit("")).alias("reference_solution"),
    )


@query(
    f"""SELECT conv_id, prompt, substr('ABCD', CAST(conv_id % 4 AS INT) + 1, 1) AS answer_key,
  concat('chunk', conv_id % 4 + 1) AS source_file
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})"""
)
def jsonl_transform(spark, sf_dir):
    transform = messages_to_prompt(keys=("conv_id",))
    read = jsonl.read_transformed(spark, _examples_file(spark, sf_dir), transform, KEYED)
    return read.select("conv_id", "prompt", "answer_key", "source_file")


@query(
    f"""SELECT row_number() OVER (ORDER BY conv_id) - 1 AS id, conv_id, prompt
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})"""
)
def jsonl_numbered(spark, sf_dir):
    """Rows numbered in the order of files and lines, which here is that of the chats."""
    path = shared_folder(spark, "ordered-examples")
    sinks.write_examples(fx.chats(spark, sf_dir).orderBy("conv_id"), path)
    numbered = file_order_ids(jsonl.read_jsonl(spark, path, KEYED))
    return numbered.transform(messages_to_prompt(keys=("id", "conv_id"), metadata=()))


FIRST = 75


@query(
    f"""SELECT row_number() OVER (ORDER BY conv_id) - 1 AS id, conv_id, prompt
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)}) ORDER BY conv_id LIMIT {FIRST}"""
)
def jsonl_first_rows(spark, sf_dir):
    """The first rows of several files, of which only as many splits are read as it takes."""
    path = shared_folder(spark, "ordered-examples")
    chats = fx.chats(spark, sf_dir).repartitionByRange(6, "conv_id").sortWithinPartitions("conv_id")
    sinks.write_examples(chats, path)
    files = sorted(jsonl.read_jsonl(spark, path, KEYED).inputFiles())
    first = first_of_files(spark, files, lambda file: jsonl.read_jsonl(spark, file, KEYED), FIRST)
    return first.transform(messages_to_prompt(keys=("id", "conv_id"), metadata=()))


@query(
    f"""SELECT conv_id, e::INT AS epoch, prompt AS query,
  {fx.sql_think_format("completion")} AS reward_1, round({fx.sql_think_format("completion")} * 0.5, 6) AS reward
FROM (SELECT *, '<think>' || length(prompt) || '</think>' || chr(10) || 'Re: ' || prompt AS completion
  FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})), range(1, 3) r(e)"""
)
def rollouts_from_file(spark, sf_dir):
    settings = {
        "datasets": [
            {
                "path": _examples_file(spark, sf_dir),
                "type": "messages_to_query",
                "keys": ("conv_id",),
            }
        ],
        "rewards": {"reward_funcs": ["think_format_reward"], "reward_weights": [0.5]},
        "num_epochs": 2,
    }
    scored = rollouts_from_settings(
        spark, settings, ("stub-generator", stubs.generator), schema=KEYED
    )
    return scored.select("conv_id", "epoch", "query", "reward_1", F.round("reward", 6).alias("reward"))


@query(
    f"""SELECT conv_id, turn, prompt, completion AS chosen, reverse(completion) AS rejected
FROM ({fx.SQL_ANSWERED})"""
)
def preference_scan(spark, sf_dir):
    pairs = fx.answered(spark, sf_dir).select(
        "conv_id", "turn", "prompt", F.col("completion").alias("chosen"),
        F.reverse("completion").alias("rejected"),
    )
    path = shared_folder(spark, "preferences")
    sinks.write_preferences(pairs, path, prompt="question", chosen="good", rejected="bad")
    carry = (T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()))
    return jsonl.read_preferences(spark, path, "question", "good", "bad", carry)


ID = "conv_id * 1024 + turn"


@query(f"SELECT {ID} AS id, prompt AS query, completion FROM ({fx.SQL_ANSWERED})")
def predictions_roundtrip(spark, sf_dir):
    answered = fx.answered(spark, sf_dir).select(
        F.expr(ID).alias("id"), F.col("prompt").alias("query"), "completion"
    )
    path = shared_folder(spark, "predictions")
    sinks.write_predictions(answered, path)
    return jsonl.read_jsonl(spark, path, PREDICTION)


def _results(spark, sf_dir):
    return judging.read_replies(fx.replies(spark, sf_dir), BUILT_IN)


@query(
    f"""SELECT {ID} AS id, {', '.join(f's_{k} AS {k}' for k in fx.KEYS)}, 6::BIGINT AS n_keys,
  round({SQL_OVERALL}, 6) + 0.0 AS overall FROM {SCORES}"""
)
def judge_results_roundtrip(spark, sf_dir):
    path = shared_folder(spark, "judge-results")
    sinks.write_judge_results(_results(spark, sf_dir).withColumn("id", F.expr(ID)), path)
    read = jsonl.read_jsonl(spark, path, JUDGE_RESULT)
    return read.select(
        "id",
        *[F.col("scores")[k].alias(k) for k in fx.KEYS],
        F.size("scores").cast("bigint").alias("n_keys"),
        fx.rounded(F.col("overall")).alias("overall"),
    )


@query(
    f"""SELECT run, round({fx.sql_weighted({k: k for k in fx.KEYS}, WEIGHTS)}, 6) + 0.0 AS overall_mean, n,
  CASE WHEN format_compliance < 3.5 THEN 'Low format_compliance' END AS decision_reason FROM (
    SELECT conv_id % 4 AS run, {', '.join(f'avg(s_{k}) AS {k}' for k in fx.KEYS)}, count(*) AS n
    FROM {SCORES} GROUP BY run)"""
)
def summary_roundtrip(spark, sf_dir):
    results = _results(spark, sf_dir).withColumn("run", F.expr("conv_id % 4"))
    path = shared_folder(spark, "summary")
    sinks.write_summary(summarize(results, BUILT_IN, ("run",)).drop("parse_failed"), path)
    schema = T.StructType([T.StructField("run", T.LongType()), *SUMMARY.fields])
    return jsonl.read_jsonl(spark, path, schema).select(
        "run", fx.rounded(F.col("overall_mean")).alias("overall_mean"), "n", "decision_reason"
    )
