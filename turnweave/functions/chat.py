"""Expressions over ``messages`` arrays."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from turnweave.functions import text as tx


@dataclass(frozen=True)
class ChatTemplate:
    """How one message becomes text, and the text that asks for the next answer.

    Every message ends in its own separator, so rendered pieces can be put together.
    """

    render: Callable[[Column, Column], Column]
    header: str
    # What follows a message's content, and how much of that is learned with the content.
    suffix: str = "\n"
    learned: str = ""


def _chatml(role: Column, content: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), content, F.lit("<|im_end|>\n"))


def _plain(role: Column, content: Column) -> Column:
    return F.concat(role, F.lit(": "), content, F.lit("\n"))


CHATML = ChatTemplate(_chatml, "<|im_start|>assistant\n", "<|im_end|>\n", "<|im_end|>")
PLAIN = ChatTemplate(_plain, "assistant: ")


def is_assistant(role: Column) -> Column:
    """A missing role does not count as the assistant's."""
    return role.eqNullSafe(F.lit("assistant"))


def without_assistant(messages: Column) -> Column:
    present = F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>"))
    return F.filter(present, lambda m: ~is_assistant(m["role"]))


def message_text(template: ChatTemplate, role: Column, content: Column) -> Column:
    return template.render(F.coalesce(role, F.lit("user")), F.coalesce(content, F.lit("")))


def render_prompt(messages: Column, template: ChatTemplate) -> Column:
    """Messages as one string that ends where the assistant starts."""
    pieces = F.transform(messages, lambda m: message_text(template, m["role"], m["content"]))
    return F.concat(F.array_join(pieces, ""), F.lit(template.header))


def last_user_text(messages: Column, prompt: Column | None = None) -> Column:
    """The newest user message; with no user turn, all contents joined by a space.

    A prompt that is already a string is returned whole.
    """
    users = F.filter(messages, lambda m: m["role"] == F.lit("user"))
    newest = F.try_element_at(users, F.lit(-1))["content"]
    contents = F.transform(messages, lambda m: F.coalesce(m["content"], F.lit("")))
    found = F.when(F.size(users) > 0, F.coalesce(newest, F.lit(""))).otherwise(
        F.array_join(contents, " ")
    )
    return found if prompt is None else F.coalesce(prompt, found)


def completion_text(completion: Column, messages: Column | None = None) -> Column:
    """A completion as text: first message's content, else the string, else empty."""
    plain = F.coalesce(completion, F.lit(""))
    if messages is None:
        return plain
    first = F.try_element_at(messages, F.lit(1))["content"]
    return F.coalesce(first, plain)


def normalize_completion(completion: Column, messages: Column | None = None) -> Column:
    """Answer text without think blocks and leading whitespace."""
    text = F.coalesce(completion, F.lit(""))
    if messages is not None:
        first = F.try_element_at(messages, F.lit(1))["content"]
        text = F.when(F.size(messages) > 0, F.coalesce(first, F.lit(""))).otherwise(text)
    return tx.lstrip(tx.strip_think(text))


def train_mask(messages: Column, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """Each message with flags for training on it and on its end-of-turn mark."""

    def mark(m: Column) -> Column:
        chosen = F.coalesce(m["role"].isin(*roles), F.lit(False))
        return F.struct(
            m["role"].alias("role"),
            m["content"].alias("content"),
            chosen.alias("train"),
            chosen.alias("train_eos"),
        )

    return F.transform(messages, mark)


def render_messages(messages: Column, template: ChatTemplate) -> Column:
    """All messages as one string, without a header for another answer."""
    present = F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>"))
    return F.array_join(F.transform(present, lambda m: message_text(template, m["role"], m["content"])), "")


def trained_spans(messages: Column, template: ChatTemplate, roles: tuple[str, ...] = ("assistant",)) -> Column:
    """Where in the rendered messages the characters to train on stand: ``[begin, end)`` of each message of ``roles``,
    its content and the learned part of what follows it."""
    present = F.coalesce(messages, F.array().cast("array<struct<role:string,content:string>>"))
    behind, learned = len(template.suffix), len(template.learned)

    def sized(m: Column) -> Column:
        content = F.coalesce(m["content"], F.lit(""))
        return F.struct(
            F.char_length(message_text(template, m["role"], m["content"])).alias("whole"),
            F.char_length(content).alias("content"),
            F.coalesce(m["role"].isin(*roles), F.lit(False)).alias("train"),
        )

    sizes = F.transform(present, sized)

    def span(m: Column, i: Column) -> Column:
        before = F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda total, x: total + x["whole"])
        end = before + m["whole"] - behind
        return F.struct((end - m["content"]).alias("begin"), (end + learned).alias("end"), m["train"].alias("train"))

    spans = F.filter(F.transform(sizes, span), lambda s: s["train"])
    return F.transform(spans, lambda s: F.struct(s["begin"], s["end"]))
