"""Chats to prompts."""

from functools import partial

from pyspark.sql import functions as F

from turnweave.catalog import fixtures as fx
from turnweave.catalog import stubs
from turnweave.catalog.registry import query
from turnweave.functions import chat
from turnweave.operators import ids, training
from turnweave.operators.preferences import PreferenceFormat, map_preferences
from turnweave.operators.transforms import messages_to_prompt, messages_to_query, row_transform, transform_from_spec
from turnweave.sources.turns import latest_user_text

KEYS = ("conv_id",)


def _listed(messages):
    lines = F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"]))
    return F.array_join(lines, "|")


@query(
    f"""SELECT conv_id, count(*) AS n_turns,
  string_agg(role, ',' ORDER BY turn) AS roles,
  string_agg(text, '|' ORDER BY turn) AS contents
FROM conversations GROUP BY conv_id"""
)
def chat_assemble(spark, sf_dir):
    return fx.chats(spark, sf_dir).select(
        *KEYS,
        F.size("messages").cast("bigint").alias("n_turns"),
        F.array_join(F.col("messages.role"), ",").alias("roles"),
        F.array_join(F.col("messages.content"), "|").alias("contents"),
    )


@query(
    f"""SELECT conv_id, count(*) FILTER (role <> 'assistant') AS n_kept,
  coalesce(string_agg(role, ',' ORDER BY turn) FILTER (role <> 'assistant'), '') AS roles
FROM conversations GROUP BY conv_id"""
)
def prune_assistant(spark, sf_dir):
    kept = chat.without_assistant(F.col("messages"))
    return fx.chats(spark, sf_dir).withColumn("kept", kept).select(
        *KEYS,
        F.size("kept").cast("bigint").alias("n_kept"),
        F.array_join(F.col("kept.role"), ",").alias("roles"),
    )


@query(fx.sql_prompts(fx.SQL_PLAIN_LINE, fx.SQL_PLAIN_HEADER))
def prompt_plain(spark, sf_dir):
    return fx.prompt_chats(spark, sf_dir).transform(messages_to_prompt(chat.PLAIN, KEYS))


@query(fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER))
def prompt_chatml(spark, sf_dir):
    return fx.prompt_chats(spark, sf_dir).transform(messages_to_prompt(chat.CHATML, KEYS))


@query(
    f"""SELECT conv_id,
  coalesce(string_agg(role || '=' || text, '|' ORDER BY turn) FILTER (role <> 'assistant'), '') AS prompt
FROM conversations GROUP BY conv_id"""
)
def prompt_messages(spark, sf_dir):
    prompts = fx.prompt_chats(spark, sf_dir).transform(messages_to_prompt(None, KEYS))
    return prompts.withColumn("prompt", _listed(F.col("prompt")))


SQL_METADATA = """substr('ABCD', CAST(conv_id % 4 AS INT) + 1, 1) AS answer_key,
  concat('chunk', conv_id % 4 + 1) AS source_file"""


@query(
    f"""SELECT conv_id, prompt, {SQL_METADATA}
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})""",
    name="messages_to_prompt",
)
def prompts_with_metadata(spark, sf_dir):
    return fx.with_metadata(fx.prompt_chats(spark, sf_dir)).transform(messages_to_prompt(keys=KEYS))


@query(
    f"""SELECT conv_id, prompt AS query
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})""",
    name="messages_to_query",
)
def queries_only(spark, sf_dir):
    return fx.with_metadata(fx.prompt_chats(spark, sf_dir)).transform(messages_to_query(keys=KEYS))


@query(
    f"""SELECT conv_id, prompt AS asked, {SQL_METADATA}
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})"""
)
def transform_by_name(spark, sf_dir):
    transform = transform_from_spec(
        {"type": "messages_to_query", "keys": KEYS, "return_field": "asked", "keep_metadata": True}
    )
    return fx.with_metadata(fx.prompt_chats(spark, sf_dir)).transform(transform)


@query(
    """SELECT conv_id,
  coalesce(max_by(text, turn) FILTER (role = 'user'), string_agg(text, ' ' ORDER BY turn)) AS user_text
FROM conversations GROUP BY conv_id"""
)
def last_user_text(spark, sf_dir):
    return latest_user_text(fx.turns(spark, sf_dir))


@query(
    f"""SELECT conv_id,
  coalesce(max_by(text, turn) FILTER (role = 'user'), string_agg(text, ' ' ORDER BY turn)) AS user_text
FROM conversations GROUP BY conv_id"""
)
def last_user_text_of_messages(spark, sf_dir):
    found = chat.last_user_text(F.col("messages")).alias("user_text")
    return fx.chats(spark, sf_dir).select(*KEYS, found)


@query(
    f"""SELECT conv_id, turn, prompt, completion AS chosen, reverse(completion) AS rejected,
  true AS complete FROM ({fx.SQL_ANSWERED})"""
)
def preference_pairs(spark, sf_dir):
    return map_preferences(_pairs(spark, sf_dir))


@query(
    f"""SELECT conv_id, turn, 'Q: ' || prompt || ' (be brief)' AS prompt,
  completion || '<end>' AS chosen, 'No: ' || reverse(completion) AS rejected, true AS complete
FROM ({fx.SQL_ANSWERED})"""
)
def preference_pairs_formatted(spark, sf_dir):
    shape = PreferenceFormat("Q: {prompt} (be brief)", "{chosen}<end>", "No: {rejected}")
    return map_preferences(_pairs(spark, sf_dir), shape)


@query(
    f"""SELECT conv_id, turn,
  '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || {fx.SQL_CHATML_HEADER} AS prompt,
  completion || '<|im_end|>' AS chosen, reverse(completion) || '<|im_end|>' AS rejected,
  true AS complete FROM ({fx.SQL_ANSWERED})"""
)
def preference_pairs_preset(spark, sf_dir):
    return map_preferences(_pairs(spark, sf_dir), "chatml.intel")


def _pairs(spark, sf_dir):
    return fx.answered(spark, sf_dir).select(
        "conv_id",
        "turn",
        "prompt",
        F.col("completion").alias("chosen"),
        F.reverse("completion").alias("rejected"),
    )


@query(
    f"""SELECT conv_id, count(*) AS n_turns,
  count(*) FILTER (role = 'assistant') AS n_trained,
  string_agg(CASE WHEN role = 'assistant' THEN '1' ELSE '0' END, '' ORDER BY turn) AS mask,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS trained_chars
FROM conversations GROUP BY conv_id"""
)
def role_mask(spark, sf_dir):
    marked = fx.chats(spark, sf_dir).withColumn("marked", chat.train_mask(F.col("messages")))
    trained = F.filter("marked", lambda m: m["train"] & m["train_eos"])
    flags = F.transform("marked", lambda m: m["train"].cast("int").cast("string"))
    return marked.select(
        *KEYS,
        F.size("marked").cast("bigint").alias("n_turns"),
        F.size(trained).cast("bigint").alias("n_trained"),
        F.array_join(flags, "").alias("mask"),
        F.aggregate(
            trained, F.lit(0).cast("bigint"), lambda a, m: a + F.length(m["content"])
        ).alias("trained_chars"),
    )


@query(
    """SELECT conv_id, min_by(text, turn) AS query, count(*) AS n_messages, sum((length(text) + 2) // 3)::BIGINT AS size
FROM conversations GROUP BY conv_id"""
)
def transform_of_rows(spark, sf_dir):
    """A transform that is a function over single examples, with a tokenizer."""
    made = row_transform(
        "size", partial(stubs.size_transform, unit="tokens"), "query string, n_messages bigint, size bigint", stubs.chunk_tokenizer, keys=KEYS
    )
    return fx.chats(spark, sf_dir).transform(made)


@query(
    f"""SELECT conv_id, CASE WHEN conv_id % 5 = 0 THEN '' ELSE left(prompt, length(prompt) - length({fx.SQL_CHATML_HEADER})) END || {fx.SQL_CHATML_HEADER} AS prompt
FROM ({fx.sql_prompts(fx.SQL_CHATML_LINE, fx.SQL_CHATML_HEADER)})"""
)
def prompt_of_nothing(spark, sf_dir):
    """Prompts where every fifth chat has no messages at all."""
    chats = fx.prompt_chats(spark, sf_dir).withColumn("messages", F.when(F.col("conv_id") % 5 != 0, F.col("messages")))
    return chats.transform(messages_to_prompt(chat.CHATML, KEYS))
