"""Completions, rewards, and reward-model inputs."""

from pyspark.sql import functions as F

from turnweave.catalog import fixtures as fx
from turnweave.catalog import stubs
from turnweave.catalog.registry import query
from turnweave.functions import chat, rewards, text, tokens
from turnweave.operators import models
from turnweave.operators.groups import group_advantage
from turnweave.operators.ledger import ask_once
from turnweave.operators.rewards import helpfulness_reward, list_reward, load_rewards, with_reward
from turnweave.operators.training import fan_out
from turnweave.plans.rollouts import scored_rollouts
from turnweave.session import materialize, shared_folder

BASE = f"({fx.SQL_COMPLETIONS})"


@query(f"SELECT conv_id, turn, {fx.sql_strip_think('completion')} AS stripped FROM {BASE}")
def strip_think(spark, sf_dir):
    stripped = text.strip_think(F.col("completion")).alias("stripped")
    return fx.completions(spark, sf_dir).select("conv_id", "turn", stripped)


@query(f"SELECT conv_id, turn, {fx.sql_normalized('completion')} AS answer FROM {BASE}")
def normalize_completion(spark, sf_dir):
    answer = chat.normalize_completion(F.col("completion")).alias("answer")
    return fx.completions(spark, sf_dir).select("conv_id", "turn", answer)


@query(
    f"""SELECT conv_id, turn, completion AS as_text, {fx.sql_normalized('completion')} AS as_answer
FROM {BASE}"""
)
def completion_messages(spark, sf_dir):
    message = F.struct(F.lit("assistant").alias("role"), F.col("completion").alias("content"))
    listed = fx.completions(spark, sf_dir).withColumn("messages", F.array(message))
    nothing = F.lit(None).cast("string")
    return listed.select(
        "conv_id",
        "turn",
        chat.completion_text(nothing, F.col("messages")).alias("as_text"),
        chat.normalize_completion(nothing, F.col("messages")).alias("as_answer"),
    )


@query(f"SELECT conv_id, turn, {fx.sql_think_format('completion')} AS reward FROM {BASE}")
def think_format_reward(spark, sf_dir):
    reward = rewards.think_format(F.col("completion")).alias("reward")
    return fx.completions(spark, sf_dir).select("conv_id", "turn", reward)


SQL_STYLE = "CASE conv_id % 3 WHEN 0 THEN 'plain' WHEN 1 THEN 'nothink' ELSE 'plain' END"
SQL_RM = f"""SELECT conv_id, turn, style,
  CASE style WHEN 'nothink' THEN prompt || ' /nothink' ELSE prompt END AS user_content,
  CASE style WHEN 'nothink' THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)
    || answer ELSE answer END AS assistant_content
FROM (SELECT conv_id, turn, prompt, {fx.sql_normalized('completion')} AS answer, {SQL_STYLE} AS style
  FROM ({fx.SQL_ANSWERED}))"""


def _reward_inputs(spark, sf_dir):
    model = F.expr(
        "CASE conv_id % 3 WHEN 0 THEN 'acme/Nemotron-8B' WHEN 1 THEN 'acme/NEMOTRON' ELSE 'acme/rm' END"
    )
    wanted = F.expr("CASE conv_id % 3 WHEN 0 THEN 'plain' ELSE 'auto' END")
    styled = fx.answered(spark, sf_dir).withColumn(
        "style", rewards.reward_model_format(model, wanted)
    )
    messages = rewards.reward_model_messages(
        F.col("prompt"), chat.normalize_completion(F.col("completion")), F.col("style")
    )
    return styled.select("conv_id", "turn", "style", messages.alias("messages"))


@query(SQL_RM)
def rm_conversation(spark, sf_dir):
    return _reward_inputs(spark, sf_dir).select(
        "conv_id",
        "turn",
        "style",
        F.col("messages")[0]["content"].alias("user_content"),
        F.col("messages")[1]["content"].alias("assistant_content"),
    )


@query(
    f"""SELECT conv_id, turn,
  'User: ' || user_content || chr(10) || 'Assistant: ' || assistant_content AS rm_text FROM ({SQL_RM})"""
)
def rm_text(spark, sf_dir):
    rendered = rewards.reward_model_text(F.col("messages")).alias("rm_text")
    return _reward_inputs(spark, sf_dir).select("conv_id", "turn", rendered)


@query("SELECT vec_id, list_extract(embedding, -1)::DOUBLE AS score FROM embeddings")
def logit_score(spark, sf_dir):
    score = rewards.last_logit(F.col("embedding")).alias("score")
    return fx.table(spark, sf_dir, "embeddings").select("vec_id", score)


@query(
    rf"""SELECT conv_id, turn, len(regexp_extract_all(completion, '\S+'))::BIGINT AS n_new,
  array_to_string(regexp_extract_all(completion, '\S+'), ' ') AS generated FROM ({fx.SQL_ANSWERED})"""
)
def generated_suffix(spark, sf_dir):
    inputs = fx.answered(spark, sf_dir).select(
        "conv_id",
        "turn",
        tokens.words(F.col("prompt")).alias("asked"),
        tokens.words(F.concat_ws(" ", "prompt", "completion")).alias("output"),
    )
    added = tokens.generated_suffix(F.col("output"), F.col("asked")).alias("added")
    return inputs.select("conv_id", "turn", added).select(
        "conv_id",
        "turn",
        F.size("added").cast("bigint").alias("n_new"),
        F.array_join("added", " ").alias("generated"),
    )


def _length_reward(prompt, completion, **columns):
    return F.length(completion).cast("double")


SQL_REWARDS = f"""SELECT conv_id, turn, {fx.sql_think_format('completion')} AS reward_1,
  length(completion)::DOUBLE AS reward_2 FROM {BASE}"""


def _rewarded(spark, sf_dir):
    loaded = load_rewards(["think_format_reward", _length_reward], [1.0, 0.2])
    asked = fx.completions(spark, sf_dir).withColumn("prompt", F.lit(""))
    return with_reward(asked, loaded)


@query(
    f"""SELECT conv_id, turn, reward_1, reward_2,
  round(reward_1 + 0.2::DOUBLE * reward_2, 6) + 0.0 AS reward FROM ({SQL_REWARDS})"""
)
def weighted_reward(spark, sf_dir):
    return _rewarded(spark, sf_dir).select(
        "conv_id", "turn", "reward_1", "reward_2", fx.rounded(F.col("reward")).alias("reward")
    )


SQL_LISTED = f"""SELECT conv_id, turn, prompt, completion, {fx.sql_normalized('completion')} AS answer
FROM (SELECT conv_id, turn, prompt, {fx.COMPLETION.replace('text', 'completion')} AS completion FROM ({fx.SQL_ANSWERED}))"""


@query(
    f"""SELECT conv_id, turn, {fx.sql_think_format('completion')} AS reward_1,
  round((length(prompt) + 9 + 0.5::DOUBLE * (length(answer) + 19)) % 97, 6) AS reward_2,
  (conv_id % 4 = 0)::INT::DOUBLE AS reward_3 FROM ({SQL_LISTED})"""
)
def rewards_of_messages(spark, sf_dir):
    """Rewards of prompts and completions that are message lists, and of a column besides."""

    def keyed(prompt, completion, answer_key):
        return (answer_key == "A").cast("double")

    answered = fx.answered(spark, sf_dir).withColumn(
        "completion", F.expr(fx.COMPLETION.replace("text", "completion"))
    )
    one = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    listed = fx.with_metadata(answered).select(
        "conv_id",
        "turn",
        "answer_key",
        F.array(one("system", F.lit("Answer.")), one("user", F.col("prompt"))).alias("prompt"),
        F.array(one("assistant", F.col("completion"))).alias("completion"),
    )
    functions = ["think_format_reward", helpfulness_reward("stub-scorer", stubs.scorer), keyed]
    scored = with_reward(listed, load_rewards(functions), columns=["answer_key"])
    return scored.select("conv_id", "turn", "reward_1", F.round("reward_2", 6).alias("reward_2"), "reward_3")


@query(
    f"""SELECT conv_id, turn, reward_1, reward_2, round(reward_1 + 0.5::DOUBLE * reward_2, 6) + 0.0 AS reward
FROM (SELECT conv_id, turn, (length(completion) % 13 + 0.25::DOUBLE * (length(prompt) % 7))::DOUBLE AS reward_1,
  (CASE WHEN conv_id % 4 = 0 THEN 2.0 ELSE 0.0 END - 0.5::DOUBLE * (turn % 3) + length(prompt))::DOUBLE AS reward_2
FROM ({fx.SQL_ANSWERED}))"""
)
def rewards_of_lists(spark, sf_dir):
    """Weighted rewards of functions over lists, one of them built per worker and with metadata."""
    answered = fx.with_metadata(fx.answered(spark, sf_dir)).select("conv_id", "turn", "prompt", "completion", "answer_key")
    functions = load_rewards([stubs.length_scores, list_reward("key-scores", stubs.key_scores)], [1.0, 0.5])
    scored = with_reward(answered, functions, columns=["answer_key", "turn"])
    return scored.select("conv_id", "turn", "reward_1", "reward_2", fx.rounded(F.col("reward")).alias("reward"))


SQL_GROUPS = f"""SELECT conv_id, turn, reward, reward - avg(reward) OVER w AS distance,
  stddev_pop(reward) OVER w AS std
FROM (SELECT conv_id, turn, reward_1 + 0.2::DOUBLE * reward_2 AS reward FROM ({SQL_REWARDS}))
WINDOW w AS (PARTITION BY conv_id)"""


@query(
    f"""SELECT conv_id, turn, round(reward, 6) + 0.0 AS reward,
  round(CASE WHEN std = 0 THEN 0.0 ELSE distance / std END, 6) + 0.0 AS advantage FROM ({SQL_GROUPS})""",
    name="group_advantage",
)
def relative_advantage(spark, sf_dir):
    return _advantages(spark, sf_dir, scale=True)


@query(
    f"""SELECT conv_id, turn, round(reward, 6) + 0.0 AS reward,
  round(distance, 6) + 0.0 AS advantage FROM ({SQL_GROUPS})""",
    name="group_advantage_dr",
)
def centered_advantage(spark, sf_dir):
    return _advantages(spark, sf_dir, scale=False)


def _advantages(spark, sf_dir, scale):
    # The narrow table of rewards is used three times, the texts are read once.
    rollouts = materialize(_rewarded(spark, sf_dir).select("conv_id", "turn", "reward"), "rewards")
    return group_advantage(rollouts, "conv_id", ("conv_id", "turn"), scale=scale).select(
        "conv_id",
        "turn",
        fx.rounded(F.col("reward")).alias("reward"),
        fx.rounded(F.col("advantage")).alias("advantage"),
    )


@query(
    """SELECT conv_id, turn, g::INT AS gen_idx, text AS prompt
FROM conversations, range(4) r(g) WHERE role = 'user'"""
)
def gen_fanout(spark, sf_dir):
    users = fx.turns(spark, sf_dir).where("role = 'user'")
    return fan_out(users.select("conv_id", "turn", F.col("text").alias("prompt")), 4)


@query(
    """SELECT conv_id, turn, '<think>' || length(text) || '</think>' || chr(10) || 'Re: ' || text AS completion
FROM conversations WHERE role = 'user'"""
)
def generate_stub(spark, sf_dir):
    users = fx.turns(spark, sf_dir).where("role = 'user'")
    completion = models.generate("stub-generator", stubs.generator, F.col("text"))
    return users.select("conv_id", "turn", completion.alias("completion"))


@query(
    """SELECT conv_id, turn, CASE WHEN text IN (SELECT text FROM conversations WHERE role = 'user' AND conv_id % 2 = 0 AND text IS NOT NULL)
  THEN '<think>' || length(text) || '</think>' || chr(10) || 'Re: ' || text ELSE 'late: ' || text END AS completion
FROM conversations WHERE role = 'user'"""
)
def resumed_generation(spark, sf_dir):
    """A run over half of the prompts and then one over all: only what the ledger lacks is asked again."""
    users = fx.turns(spark, sf_dir).where("role = 'user'").select("conv_id", "turn", "text")
    folder = shared_folder(spark, "ledger")

    def run(rows, factory):
        ask = lambda text: models.generate("stub-generator", factory, text)
        return ask_once(rows, F.col("text"), "completion", ask, folder, "stub-generator", batch_rows=1000)

    run(users.where("conv_id % 2 = 0"), stubs.generator)
    return run(users, stubs.late_generator).select("conv_id", "turn", "completion")


@query(
    f"""SELECT conv_id, turn,
  round((length(user_content) + 0.5::DOUBLE * length(assistant_content)) % 97, 6) AS score FROM ({SQL_RM})"""
)
def rm_score_stub(spark, sf_dir):
    logits = models.reward_logits("stub-scorer", stubs.scorer, F.col("messages"))
    score = F.round(rewards.last_logit(logits), 6).alias("score")
    return _reward_inputs(spark, sf_dir).select("conv_id", "turn", score)


SQL_ROLLOUTS = f"""SELECT conv_id, turn, e::INT AS epoch, text AS prompt,
  '<think>' || length(text) || '</think>' || chr(10) || 'Re: ' || text AS completion
FROM conversations, range(1, 3) r(e) WHERE role = 'user'"""


@query(
    f"""SELECT conv_id, turn, epoch, completion,
  round((length(prompt) + 9 + 0.5::DOUBLE * (length({fx.sql_normalized('completion')}) + 19)) % 97, 6) + 0.0
    AS reward_1,
  {fx.sql_think_format('completion')} AS reward_2,
  round((length(prompt) + 9 + 0.5::DOUBLE * (length({fx.sql_normalized('completion')}) + 19)) % 97
    + 0.2::DOUBLE * {fx.sql_think_format('completion')}, 6) + 0.0 AS reward
FROM ({SQL_ROLLOUTS})"""
)
def ppo_rollouts(spark, sf_dir):
    queries = fx.turns(spark, sf_dir).where("role = 'user'").select(
        "conv_id", "turn", F.col("text").alias("query")
    )
    helpful = helpfulness_reward("stub-scorer", stubs.scorer)
    scored = scored_rollouts(
        queries,
        ("stub-generator", stubs.generator),
        load_rewards([helpful, "think_format_reward"], [1.0, 0.2]),
        epochs=2,
    )
    return scored.select(
        "conv_id",
        "turn",
        "epoch",
        "completion",
        fx.rounded(F.col("reward_1")).alias("reward_1"),
        "reward_2",
        fx.rounded(F.col("reward")).alias("reward"),
    )
