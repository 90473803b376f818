"""Which data each training stage uses.

An experiment is a row with an array of masks; each mask is a series of three stages.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.functions import stages as st
from turnweave.session import BROADCAST_ROWS, broadcast_if_small, local_table

# Masks that are run by default, and (algorithm, dataset index, chunk).
DEFAULT_MASKS = (0, 6)
DEFAULT_DATASETS = (
    ("sft", 0, "chunk1"),
    ("sft", 1, "chunk2"),
    ("sft", 2, "chunk4"),
    ("dpo", 0, "chunk2"),
    ("dpo", 1, "chunk4"),
)

# What tells the runs of datasets apart.
RUN = ("alg", "chunk", "run_id")

# Places that a plan beyond the bound for broadcasts and its training rows are dealt to, at least.
SALTS = 16
# Rows of either side in a place.
PLACE_ROWS = 50_000

MANIFEST = T.StructType(
    [
        T.StructField("alg", T.StringType()),
        T.StructField("dataset_idx", T.IntegerType()),
        T.StructField("chunk", T.StringType()),
    ]
)


def dataset_manifest(spark: SparkSession, datasets=DEFAULT_DATASETS) -> DataFrame:
    rows = [dict(zip(MANIFEST.names, dataset)) for dataset in datasets]
    return local_table(spark, rows, MANIFEST)


def series_of(experiments: DataFrame, masks: str = "masks") -> DataFrame:
    """One row per mask, ``series`` counting from 1 in each experiment."""
    others = [c for c in experiments.columns if c != masks]
    return experiments.select(*others, F.posexplode(masks).alias("series", "mask")).withColumn(
        "series", F.col("series") + 1
    )


def stage_plan(
    series: DataFrame,
    initial_model: str,
    timestamp: str,
    prefix: str = "order",
    runs_dir: str = "runs",
) -> DataFrame:
    """Three rows per series: algorithm, dataset index, run id, and the model to start from.

    A stage starts from the run directory of the one before it. All three stages are
    built from the series row, so nothing is shuffled.
    """
    mask, number = F.col("mask"), F.col("series")
    steps = F.sequence(F.lit(0), F.lit(st.STAGES - 1))

    def one(stage):
        algorithm = st.stage_algorithm(mask, stage)
        return F.struct(
            stage.alias("stage"),
            algorithm.alias("alg"),
            st.dataset_index(algorithm, stage).alias("dataset_idx"),
            st.run_id(prefix, timestamp, mask, number, stage, algorithm).alias("run_id"),
        )

    planned = series.withColumn("_stages", F.transform(steps, one))
    previous = F.get("_stages", F.col("_stage.stage") - 1)["run_id"]
    return planned.withColumn("_stage", F.explode("_stages")).select(
        *series.columns,
        "_stage.*",
        F.coalesce(F.concat(F.lit(f"{runs_dir}/"), previous), F.lit(initial_model)).alias("base_model"),
    )


def with_datasets(plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Add each stage's ``chunk``; null where the manifest has none."""
    return plan.join(broadcast_if_small(manifest), ["alg", "dataset_idx"], "left")


def missing_datasets(plan: DataFrame, manifest: DataFrame) -> DataFrame:
    """Stages whose dataset the manifest does not have."""
    return plan.join(broadcast_if_small(manifest), ["alg", "dataset_idx"], "left_anti")


def runs_of(plan: DataFrame) -> list[Row]:
    """Each dataset and run of a plan once, in order. A run id names masks and stages, not whom they are for, so they are few."""
    return plan.select(*RUN).distinct().orderBy(*RUN).collect()


def with_run_numbers(plan: DataFrame, runs: list[Row]) -> DataFrame:
    """Add each stage's ``run``, its place in the ``runs_of`` the plan."""
    kinds = T.StructType([*(T.StructField(f"_{c}", T.StringType()) for c in RUN), T.StructField("run", T.LongType())])
    numbers = local_table(plan.sparkSession, [dict(zip(kinds.names, (*run, i))) for i, run in enumerate(runs)], kinds)
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in RUN]
    return plan.join(broadcast_if_small(numbers), same).select(*plan.columns, "run")


def rows_of_datasets(joined: DataFrame, runs: list[Row]) -> DataFrame:
    """How many ``stage_rows`` each dataset has, and how many runs that have names use it, by their numbers.

    Every row is counted. Each dataset's rows are counted on their own, without groups, as a look-up in a table
    of groups takes some ten times as long as all else that is done for a row. Runs share numbers of 64 bits.
    """
    members: dict[tuple, list[int]] = {}
    for number, (*dataset, _) in enumerate(runs):
        members.setdefault(tuple(dataset), []).append(number)

    def counted(alg: str, chunk: str, own: list[int]) -> DataFrame:
        # The runs of a dataset follow one another.
        place = (F.col("run") - own[0]).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
        words = [own[at : at + 64] for at in range(0, len(own), 64)]
        here = [bit] if len(words) == 1 else [F.when(F.shiftright(place, 6) == w, bit) for w in range(len(words))]
        seen = [F.bit_or(bits).alias(f"_word{w}") for w, bits in enumerate(here)]
        found = joined.where(F.col("run").between(own[0], own[-1])).agg(F.count(F.lit(1)).alias("n_rows"), *seen)
        used = F.lit(0)
        for w, numbers in enumerate(words):
            named = sum(1 << i for i, n in enumerate(numbers) if runs[n].run_id is not None)
            signed = named - (1 << 64) if named >> 63 else named
            used = used + F.bit_count(F.coalesce(F.col(f"_word{w}"), F.lit(0)).bitwiseAND(F.lit(signed).cast("bigint")))
        return found.where("n_rows > 0").select(F.lit(alg).alias("alg"), F.lit(chunk).alias("chunk"), "n_rows", used.cast("bigint").alias("n_runs"))

    parts = [counted(*dataset, own) for dataset, own in members.items()]
    none = joined.limit(0).select("alg", "chunk", F.lit(0).cast("bigint").alias("n_rows"), F.lit(0).cast("bigint").alias("n_runs"))
    return reduce(DataFrame.unionByName, parts) if parts else none


def _place(side: DataFrame, places: int) -> Column:
    """A row's place by its columns; maps and variants have no hash."""
    hashed = [f.name for f in side.schema if not re.search("map<|variant", f.dataType.simpleString())]
    return F.pmod(F.xxhash64(*hashed), F.lit(places)).cast("int")


def stage_rows(plan: DataFrame, rows: DataFrame, max_plan_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The training rows of each stage: ``rows`` has ``alg`` and ``chunk``.

    Rows stay where they are; the plan, a few rows per mask, goes to them. A plan of more than
    ``max_plan_rows`` is dealt by hash, and so are the rows, to a grid of places: a place holds about
    ``PLACE_ROWS`` of either side, a plan row goes to all places of its line and a training row to all of its
    column, so each two meet in one. So the few chunks' keys do not hold all of a join, and each side is copied
    by the other's size over ``PLACE_ROWS``, however large both are. The partitions are set, as adaptive
    execution would merge them by the bytes they read, which the pairs they make dwarf. A join by sorting reads
    a plan row once for the training rows it meets, which lie side by side, a place's at once.
    """
    hinted = broadcast_if_small(plan, max_plan_rows)
    if hinted is not plan:
        return rows.join(hinted, ["alg", "chunk"])
    columns = max(1, -(-rows.count() // PLACE_ROWS))
    lines = max(-(-plan.count() // PLACE_ROWS), -(-SALTS // columns))
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in (lines, columns)]
    sides = (
        plan.select("*", _place(plan, lines).alias("_line"), every[1].alias("_column")),
        rows.select("*", _place(rows, columns).alias("_column"), every[0].alias("_line")),
    )
    keys = ["alg", "chunk", "_line", "_column"]
    partitions = max(lines * columns, int(plan.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = [side.repartition(partitions, *keys) for side in sides]
    others = [c for side in (rows, plan) for c in side.columns if c not in keys]
    return dealt[0].join(dealt[1], keys).select("alg", "chunk", *others)
