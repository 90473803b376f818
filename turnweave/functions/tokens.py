"""Token counts and token arrays. The tokenizer is a parameter; words are the default."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

Tokenizer = Callable[[Column], Column]

WORD = r"\S+"


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def generated_suffix(output: Column, prompt: Column) -> Column:
    """The tokens a model added after its prompt's tokens."""
    added = F.greatest(F.size(output) - F.size(prompt), F.lit(0))
    return F.slice(output, F.size(prompt) + 1, added)


def cap_tokens(tokens: Column, limit: int) -> Column:
    return F.slice(tokens, 1, limit)
