"""Arithmetic on keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floor_div(value: Column, size: int) -> Column:
    """Integer division that rounds down and stays exact for large keys."""
    whole = value - F.pmod(value, F.lit(size))
    return F.call_function("div", whole, F.lit(size)).cast("bigint")
