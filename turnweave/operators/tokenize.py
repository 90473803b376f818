"""Tokenizers that work on batches of texts, and what is made of their tokens.

A tokenizer is given by a factory that returns a function from a list of texts to a list of token ids
per text, or of ``(id, begin, end)`` tokens with the places of their characters. It is built once per
worker, and gets texts of about ``CALL_BYTES`` at once, or one longer text. Where only lengths are asked
for, no ids come back from Python.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.functions import chat
from turnweave.operators import models

IGNORED = -100
# UTF-8 bytes of the texts of one call, if it is of more than one text.
CALL_BYTES = 1 << 18
TOKEN = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType())])


@dataclass(frozen=True)
class BatchTokenizer:
    """A tokenizer as column expressions. Called with a column it counts tokens, so that it can stand
    wherever a token count is a parameter. A null text has no tokens."""

    name: str
    factory: Callable[[], Callable[[list], list]]
    batch_size: int = 256

    def _column(self, text: Column, kind: T.DataType, make: Callable[[list], pa.Array]) -> Column:
        name, factory, size = self.name, self.factory, max(1, self.batch_size)
        key = models.identity(name, factory)

        @F.arrow_udf(kind)
        def call(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokenize = models.once_per_worker(key, factory)
            for batch in batches:
                # Each call's tokens go back at once: as Python objects they take many times their text.
                for part in _parts(batch, size, CALL_BYTES):
                    found = list(tokenize(part.to_pylist()))
                    if len(found) != len(part):
                        raise ValueError(f"{name} must return one list of tokens per text")
                    yield make(found)

        return call(F.coalesce(text, F.lit("")))

    def __call__(self, text: Column) -> Column:
        """How many tokens a text has."""
        return self._column(text, T.LongType(), _counts)

    def ids(self, text: Column) -> Column:
        return self._column(text, T.ArrayType(T.IntegerType()), _ids)

    def tokens(self, text: Column) -> Column:
        """Ids with the places of their characters; the tokenizer has to give ``(id, begin, end)``."""
        return self._column(text, T.ArrayType(TOKEN), _places)


def _parts(batch: pa.Array, rows: int, size: int) -> Iterator[pa.Array]:
    """A batch in slices of at most ``rows`` texts and ``size`` bytes; a longer text is alone."""
    lengths = pc.fill_null(pc.binary_length(batch), 0).to_pylist()
    start, held = 0, 0
    for i, length in enumerate(lengths):
        if i > start and (i - start == rows or held + length > size):
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += length
    yield batch.slice(start)


def _counts(found: list) -> pa.Array:
    return pa.array(list(map(len, found)), pa.int64())


def _lists(found: list, values: pa.Array) -> pa.Array:
    """``values`` of all texts, dealt to each by how many tokens it has."""
    offsets = np.concatenate([[0], np.cumsum([len(tokens) for tokens in found], dtype=np.int64)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _ids(found: list) -> pa.Array:
    flat = [t[0] if isinstance(t, (tuple, list)) else t for tokens in found for t in tokens]
    return _lists(found, pa.array(flat, pa.int32()))


def _places(found: list) -> pa.Array:
    flat = [(i, b, e) for tokens in found for i, b, e in tokens]
    fields = [pa.array([t[n] for t in flat], pa.int32()) for n in range(3)]
    return _lists(found, pa.StructArray.from_arrays(fields, ["id", "begin", "end"]))


def with_token_ids(df: DataFrame, text: str, tokenizer: BatchTokenizer, name: str = "token_ids") -> DataFrame:
    """Add the ids of a text's tokens."""
    return df.withColumn(name, tokenizer.ids(F.col(text)))


def labels(tokens: Column, spans: Column) -> Column:
    """The id of each token that lies within one of the ``spans``, ``IGNORED`` for the others.

    A token that reaches over the border of a span is not trained on.
    """

    def within(t: Column) -> Column:
        return F.exists(spans, lambda s: (t["begin"] >= s["begin"]) & (t["end"] <= s["end"]))

    return F.transform(tokens, lambda t: F.when(within(t), t["id"]).otherwise(F.lit(IGNORED)))


def with_labels(
    df: DataFrame,
    tokenizer: BatchTokenizer,
    messages: str = "messages",
    template: chat.ChatTemplate = chat.CHATML,
    roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Add ``text``, ``token_ids`` and ``labels`` of whole chats.

    Trained on are the contents of messages of ``roles`` and the mark that ends them; everything else has
    the label ``IGNORED``. A null list of messages is an empty text without tokens.
    """
    spoken = df.withColumns({"text": chat.render_messages(F.col(messages), template), "_spans": chat.trained_spans(F.col(messages), template, roles)})
    split = spoken.withColumn("_tokens", tokenizer.tokens(F.col("text")))
    return split.withColumns({"token_ids": F.col("_tokens.id"), "labels": labels(F.col("_tokens"), F.col("_spans"))}).drop("_spans", "_tokens")
