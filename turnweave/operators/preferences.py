"""Preference pairs shaped by text templates."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PreferenceFormat:
    prompt: str = "{prompt}"
    chosen: str = "{chosen}"
    rejected: str = "{rejected}"


# Formats with a name.
PRESETS = {
    "user_defined.default": PreferenceFormat(),
    "chatml.intel": PreferenceFormat(
        "<|im_start|>user\n{prompt}<|im_end|>\n<|im_start|>assistant\n",
        "{chosen}<|im_end|>",
        "{rejected}<|im_end|>",
    ),
}

FIELDS = ("prompt", "chosen", "rejected")


def fill(template: str) -> Column:
    """A template with ``{field}`` places, as a concatenation. Null if a field is null."""
    places = "|".join(FIELDS)
    pieces = re.split(rf"\{{({places})\}}", template)
    # The split puts literal text at even and field names at odd positions.
    columns = [
        F.col(piece) if i % 2 else F.lit(piece) for i, piece in enumerate(pieces) if i % 2 or piece
    ]
    return F.concat(*columns) if columns else F.lit("")


def named_format(name: str) -> PreferenceFormat:
    """The format of a dataset type; every type that begins with ``user_defined`` takes the fields
    as they are unless templates are given."""
    if name in PRESETS:
        return PRESETS[name]
    if name.startswith("user_defined"):
        return PreferenceFormat()
    raise KeyError(f"unknown format {name!r}; known: {sorted(PRESETS)}")


def map_preferences(pairs: DataFrame, shape: PreferenceFormat | str = PreferenceFormat()) -> DataFrame:
    """Fill the templates; other columns stay. ``complete`` is false if a field is missing."""
    if isinstance(shape, str):
        shape = named_format(shape)
    filled = {name: fill(getattr(shape, name)) for name in FIELDS}
    complete = F.col("prompt").isNotNull() & F.col("chosen").isNotNull() & F.col("rejected").isNotNull()
    return pairs.withColumns({**filled, "complete": complete})


def incomplete(mapped: DataFrame) -> DataFrame:
    return mapped.where(~F.col("complete"))
