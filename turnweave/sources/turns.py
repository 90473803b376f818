"""Chats stored one turn per row.

A chat becomes one row, as an example in a file is one row: grouping it needs as much memory
as that one value. Where no whole chat is asked for, nothing is gathered: the next turn of a turn is
found within ``(chat, turn // span)``, and the newest user message is an aggregate, so a chat that
holds a third of the table is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnweave.functions.chat import is_assistant
from turnweave.functions.numbers import floor_div
from turnweave.session import broadcast_if_small, materialize

# Turns looked at together when a turn's next one is sought.
SPAN = 1024

# A row cannot hold more; a chat beyond it fails with its id.
MOST_BYTES = 1 << 30


@dataclass(frozen=True)
class TurnColumns:
    chat: str = "conv_id"
    turn: str = "turn"
    role: str = "role"
    content: str = "text"


DEFAULT_COLUMNS = TurnColumns()


def turn_part(turn: Column, span: int) -> Column:
    return floor_div(turn, span)


def _whole(chat: str, bytes_: Column, value: Column, most: int) -> Column:
    """``value``, or an error that names the chat if its texts are too large for one row."""
    message = F.concat(F.lit("chat "), F.col(chat).cast("string"), F.lit(f" has more than {most} bytes of text"))
    return F.when(F.coalesce(bytes_, F.lit(0)) <= most, value).otherwise(F.raise_error(message))


def assemble_chats(
    turns: DataFrame,
    names: TurnColumns = DEFAULT_COLUMNS,
    prompts_only: bool = False,
    most_bytes: int = MOST_BYTES,
) -> DataFrame:
    """Rows ``(chat, messages)``, one per chat, its messages by turn.

    ``prompts_only`` leaves assistant turns out. Their texts, most of the bytes of a
    chat, then take no part in the shuffle; every chat keeps its row.
    """
    entry = F.struct(
        F.col(names.turn).alias("turn"),
        F.col(names.role).alias("role"),
        F.col(names.content).alias("content"),
    )
    size = F.octet_length(names.content)
    if prompts_only:
        asked = ~is_assistant(F.col(names.role))
        entry, size = F.when(asked, entry), F.when(asked, size)
    messages = F.transform(
        "_entries", lambda e: F.struct(e["role"].alias("role"), e["content"].alias("content"))
    )
    return (
        turns.groupBy(names.chat)
        .agg(F.sort_array(F.collect_list(entry)).alias("_entries"), F.sum(size).alias("_bytes"))
        .select(names.chat, _whole(names.chat, F.col("_bytes"), messages, most_bytes).alias("messages"))
    )


def latest_user_text(
    turns: DataFrame, names: TurnColumns = DEFAULT_COLUMNS, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """Rows ``(chat, user_text)``: each chat's newest user message.

    Chats with no user turn give all their contents joined by spaces. One message per chat
    is written to the shared folder, so that the texts are grouped a second time only for
    chats that need it.
    """
    role, content, turn = F.col(names.role), F.col(names.content), F.col(names.turn)
    from_user = role == F.lit("user")
    newest = materialize(
        turns.groupBy(names.chat).agg(
            F.max_by(
                F.when(from_user, F.struct(F.coalesce(content, F.lit("")).alias("text"))),
                F.when(from_user, turn),
            ).alias("newest")
        ),
        "newest-user",
    )
    found = newest.where("newest IS NOT NULL").select(names.chat, F.col("newest.text").alias("user_text"))
    without = newest.where("newest IS NULL").select(names.chat)
    if without.isEmpty():
        return found
    entry = F.struct(turn.alias("turn"), F.coalesce(content, F.lit("")).alias("content"))
    joined = (
        turns.join(broadcast_if_small(without), names.chat)
        .groupBy(names.chat)
        .agg(F.sort_array(F.collect_list(entry))["content"].alias("_contents"), F.sum(F.octet_length(content)).alias("_bytes"))
        .select(
            names.chat,
            _whole(names.chat, F.col("_bytes"), F.array_join("_contents", " "), most_bytes).alias("user_text"),
        )
    )
    return found.unionByName(joined)


def previous_parts(parts: DataFrame, chat: str, span: int) -> DataFrame:
    """For distinct ``(chat, part)`` rows the part before each, 0 for the first.

    The look back runs within blocks of ``span`` parts; only each block's highest part is
    compared across a whole chat.
    """
    blocked = parts.withColumn("block", floor_div(F.col("part"), span))
    in_block = Window.partitionBy(chat, "block").orderBy("part")
    over_blocks = Window.partitionBy(chat).orderBy("block")
    tops = (
        blocked.groupBy(chat, "block")
        .agg(F.max("part").alias("top"))
        .select(chat, "block", F.lag("top").over(over_blocks).alias("below"))
    )
    return (
        blocked.withColumn("before", F.lag("part").over(in_block))
        .join(tops, [chat, "block"])
        .select(
            chat,
            "part",
            F.coalesce("before", "below", F.lit(0).cast("bigint")).alias("previous"),
        )
    )


def with_next_turn(
    turns: DataFrame, names: TurnColumns = DEFAULT_COLUMNS, span: int = SPAN
) -> DataFrame:
    """Each turn with ``next``, the struct of the turn after it in the same chat.

    The window runs within a part. The last turn of a part finds its next one among the
    first turns of later parts, of which ordinary chats have none.
    """
    fields = {"turn": names.turn, "role": names.role, "content": names.content}
    part = turn_part(F.col(names.turn), span)
    inside = Window.partitionBy(names.chat, "part").orderBy(names.turn)
    head = F.struct(*[F.col(column).alias(field) for field, column in fields.items()])
    later = turns.where(F.col(names.turn) >= span).withColumn("part", part)
    # Numbers alone find the first turns of later parts; their texts are fetched by key.
    heads = later.groupBy(names.chat, "part").agg(F.min(names.turn).alias(names.turn))
    before = previous_parts(heads.select(names.chat, "part"), names.chat, span)
    borders = (
        heads.join(before, [names.chat, "part"])
        .select(names.chat, names.turn, "previous")
        .join(later, [names.chat, names.turn])
        .select(names.chat, F.col("previous").alias("part"), head.alias("border"))
    )
    # Leads of plain columns: a lead of a struct would shuffle every text twice.
    leads = {f"_{field}": F.lead(column).over(inside) for field, column in fields.items()}
    follower = F.struct(*[F.col(f"_{field}").alias(field) for field in fields])
    return (
        turns.withColumn("part", part)
        .withColumns(leads)
        .join(borders, [names.chat, "part"], "left")
        .withColumn("next", F.when(F.col("_turn").isNotNull(), follower).otherwise(F.col("border")))
        .drop("part", "border", *leads)
    )


def answered_turns(
    turns: DataFrame, names: TurnColumns = DEFAULT_COLUMNS, span: int = SPAN
) -> DataFrame:
    """User turns that an assistant turn follows: ``(chat, turn, prompt, completion)``."""
    return (
        with_next_turn(turns, names, span)
        .where((F.col(names.role) == "user") & (F.col("next.role") == "assistant"))
        .select(
            names.chat,
            names.turn,
            F.col(names.content).alias("prompt"),
            F.col("next.content").alias("completion"),
        )
    )
