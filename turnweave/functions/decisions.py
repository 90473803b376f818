"""From category means to training advice."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of choices, thresholds, and advice texts.
ALGORITHM_CHOICES = ("SFT", "GRPO", "DPO")
FORMAT_LIMIT = 3.5
STYLE_LIMIT = 3.5
ADEQUATE = 3.5
REASONING_LIMIT = 3.2
HELPFUL_LIMIT = 3.2
SAFETY_LIMIT = 4.0
FORMAT_ADVICE = (
    "Improve formatting: try SFT with format-focused data or GRPO with think_format_reward."
)
STYLE_ADVICE = "Polish style: short SFT pass emphasizing clarity/conciseness."
REASONING_ADVICE = (
    "Boost reasoning/correctness: GRPO with helpfulness/correctness rewards or PPO with a verifier."
)
HELPFUL_ADVICE = "Preference alignment: DPO/ORPO with better chosen-vs-rejected pairs."
SAFETY_ADVICE = "Safety: add safety-focused SFT data or a safety reward in RL."
FORMAT_REASON = "Low format_compliance"
REASONING_REASON = "Low correctness and/or reasoning_quality"
HELPFUL_REASON = "Low helpfulness with adequate formatting"
STYLE_REASON = "Low style_clarity"
SAFETY_REASON = "Low safety"
DEFAULT_REASON = "Default (no critical weaknesses detected)"


def _weaknesses(means: Column) -> dict[str, Column]:
    """Tests on a map of means. A category the rubric lacks counts as 5."""

    def mean(key: str) -> Column:
        return F.coalesce(means[key], F.lit(5.0))

    return {
        "format": mean("format_compliance") < FORMAT_LIMIT,
        "style": mean("style_clarity") < STYLE_LIMIT,
        "polish": (mean("style_clarity") < STYLE_LIMIT) & (mean("helpfulness") >= ADEQUATE),
        "reasoning": (mean("correctness") < REASONING_LIMIT)
        | (mean("reasoning_quality") < REASONING_LIMIT),
        "helpful": (mean("helpfulness") < HELPFUL_LIMIT)
        & (mean("format_compliance") >= ADEQUATE),
        "safety": mean("safety") < SAFETY_LIMIT,
    }


def suggestions(means: Column) -> Column:
    """All advice that applies, in order."""
    weak = _weaknesses(means)
    advice = [
        F.when(weak["format"], F.lit(FORMAT_ADVICE)),
        F.when(weak["polish"], F.lit(STYLE_ADVICE)),
        F.when(weak["reasoning"], F.lit(REASONING_ADVICE)),
        F.when(weak["helpful"], F.lit(HELPFUL_ADVICE)),
        F.when(weak["safety"], F.lit(SAFETY_ADVICE)),
    ]
    return F.array_compact(F.array(*advice))


def next_algorithm(means: Column) -> Column:
    """The one next step, as a struct ``(name, index, reason)``; the first match counts."""
    weak = _weaknesses(means)

    def choice(name: str, reason: str) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            F.lit(ALGORITHM_CHOICES.index(name)).alias("index"),
            F.lit(reason).alias("reason"),
        )

    return (
        F.when(weak["format"], choice("SFT", FORMAT_REASON))
        .when(weak["reasoning"], choice("GRPO", REASONING_REASON))
        .when(weak["helpful"], choice("DPO", HELPFUL_REASON))
        .when(weak["style"], choice("SFT", STYLE_REASON))
        .when(weak["safety"], choice("SFT", SAFETY_REASON))
        .otherwise(choice("SFT", DEFAULT_REASON))
    )


def algorithm_choices() -> Column:
    return F.array(*[F.lit(name) for name in ALGORITHM_CHOICES])
