"""Expressions over stage masks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAGES = 3


def mask_bit(mask: Column, stage: Column) -> Column:
    return F.call_function("shiftright", mask.cast("int"), stage).bitwiseAND(F.lit(1))


def stage_algorithm(mask: Column, stage: Column) -> Column:
    """Stage 0 is always SFT; later stages are DPO when their bit is set."""
    later_dpo = (stage > 0) & (mask_bit(mask, stage) == 1)
    return F.when(later_dpo, F.lit("dpo")).otherwise(F.lit("sft"))


def dataset_index(algorithm: Column, stage: Column) -> Column:
    """SFT datasets are numbered by stage, DPO datasets from stage 1 on."""
    return F.when(algorithm == "dpo", stage - 1).otherwise(stage)


def run_id(prefix: str, timestamp: str, mask: Column, series: Column, stage: Column,
           algorithm: Column) -> Column:
    return F.format_string(
        f"{prefix}_m%d_{timestamp}_s%d_stage%d_%s_{timestamp}", mask, series, stage, algorithm
    )
