"""String expressions shared by rewards and judging."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's ``re`` and ``str.strip`` count as whitespace (fixed values). Java's \s and
# Spark's trim without characters cover less.
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Fixed values.
THINK_BLOCK = rf"(?s)<think>.*?</think>[{SPACES}]*"
# [\s\S] in place of the dot would match the same and take many times as long.
JSON_OBJECT = r"(?s)\{.*\}"
THINK_THEN_ANSWER = r"(?s)^<think>(?!.*<think>).*?</think>.*\S"
THINK_ONLY = r"(?s)^<think>(?!.*<think>).*?</think>"


def strip_think(text: Column) -> Column:
    """Remove every closed think block and the whitespace after it."""
    return F.regexp_replace(text, F.lit(THINK_BLOCK), F.lit(""))


def lstrip(text: Column) -> Column:
    return F.ltrim(text, F.lit(SPACES))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def isolate_json(text: Column) -> Column:
    """From the first ``{`` to the last ``}``; empty when there is no such span."""
    return F.regexp_extract(text, JSON_OBJECT, 0)
