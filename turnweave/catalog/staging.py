"""Stage plans and the rows each stage trains on."""

from pyspark.sql import functions as F

from turnweave.catalog import fixtures as fx
from turnweave.catalog.registry import query
from turnweave.plans import stages

STAMP = "20250101_000000"


def _plan(spark, sf_dir):
    """One experiment per user of the events, with two masks each."""
    users = fx.table(spark, sf_dir, "events").select("user_id").distinct()
    masks = F.expr("array(CAST(user_id % 8 AS INT), CAST((user_id + 6) % 8 AS INT))")
    series = stages.series_of(users.withColumn("masks", masks))
    return stages.stage_plan(series, "base", STAMP)


def sql_manifest(datasets=stages.DEFAULT_DATASETS) -> str:
    rows = ", ".join(f"('{alg}', {i}::INT, '{chunk}')" for alg, i, chunk in datasets)
    return f"(VALUES {rows}) m(alg, dataset_idx, chunk)"


def sql_plan(series: str, key: str = "user_id") -> str:
    """A plan over rows ``(key, series, mask)``."""
    keys = f"{key}, " if key else ""
    return f"""SELECT *, coalesce('runs/' || lag(run_id) OVER (
    PARTITION BY {keys}series ORDER BY stage), 'base') AS base_model
FROM (SELECT *, 'order_m' || mask || '_{STAMP}_s' || series || '_stage' || stage || '_' || alg
    || '_{STAMP}' AS run_id
  FROM (SELECT *, CASE alg WHEN 'dpo' THEN stage - 1 ELSE stage END AS dataset_idx
    FROM (SELECT {keys}series, mask, s::INT AS stage,
        CASE WHEN s > 0 AND (mask >> s) & 1 = 1 THEN 'dpo' ELSE 'sft' END AS alg
      FROM ({series}), range(3) r(s))))"""


SQL_SERIES = """SELECT DISTINCT user_id, 1 AS series, (user_id % 8)::INT AS mask FROM events
UNION ALL SELECT DISTINCT user_id, 2, ((user_id + 6) % 8)::INT FROM events"""


@query(
    f"""SELECT p.*, m.chunk FROM ({sql_plan(SQL_SERIES)}) p
LEFT JOIN {sql_manifest()} USING (alg, dataset_idx)"""
)
def stage_plan(spark, sf_dir):
    return stages.with_datasets(_plan(spark, sf_dir), stages.dataset_manifest(spark))


PRESENT = stages.DEFAULT_DATASETS[:-1]


@query(
    f"""SELECT user_id, series, stage, alg, dataset_idx, run_id
FROM ({sql_plan(SQL_SERIES)}) ANTI JOIN {sql_manifest(PRESENT)} USING (alg, dataset_idx)"""
)
def stage_missing_dataset(spark, sf_dir):
    missing = stages.missing_datasets(
        _plan(spark, sf_dir), stages.dataset_manifest(spark, PRESENT)
    )
    return missing.select("user_id", "series", "stage", "alg", "dataset_idx", "run_id")


SQL_DEFAULT_SERIES = "SELECT * FROM (VALUES (1::INT, 0::INT), (2::INT, 6::INT)) d(series, mask)"


@query(
    f"""SELECT conv_id, turn, text, alg, chunk, series, stage, run_id, base_model FROM (
  SELECT conv_id, turn, text, alg, 'chunk' || (conv_id % 4 + 1) AS chunk
  FROM conversations, (VALUES ('sft'), ('dpo')) a(alg) WHERE role = 'user')
JOIN (SELECT p.*, m.chunk FROM ({sql_plan(SQL_DEFAULT_SERIES, '')}) p
  JOIN {sql_manifest()} USING (alg, dataset_idx)) USING (alg, chunk)"""
)
def stage_rows(spark, sf_dir):
    experiment = spark.range(1).select(F.array(*map(F.lit, stages.DEFAULT_MASKS)).alias("masks"))
    plan = stages.with_datasets(
        stages.stage_plan(stages.series_of(experiment), "base", STAMP),
        stages.dataset_manifest(spark),
    )
    rows = fx.turns(spark, sf_dir).where("role = 'user'").select(
        "conv_id",
        "turn",
        "text",
        F.explode(F.array(F.lit("sft"), F.lit("dpo"))).alias("alg"),
        F.expr("concat('chunk', conv_id % 4 + 1)").alias("chunk"),
    )
    return stages.stage_rows(plan, rows).select(
        "conv_id", "turn", "text", "alg", "chunk", "series", "stage", "run_id", "base_model"
    )


@query(
    f"""SELECT alg, chunk, count(*) AS n_rows, count(DISTINCT run_id) AS n_runs FROM (
  SELECT conv_id, turn, alg, 'chunk' || (conv_id % 4 + 1) AS chunk
  FROM conversations, (VALUES ('sft'), ('dpo')) a(alg) WHERE role = 'user')
JOIN (SELECT p.*, m.chunk FROM ({sql_plan(SQL_SERIES)}) p JOIN {sql_manifest()} USING (alg, dataset_idx)) USING (alg, chunk)
GROUP BY alg, chunk"""
)
def stage_rows_of_large_plan(spark, sf_dir):
    """Rows per dataset of the stages of many experiments, by the way that plans beyond a broadcast take."""
    plan = stages.with_datasets(_plan(spark, sf_dir), stages.dataset_manifest(spark)).select("alg", "chunk", "run_id", "user_id", "series", "stage")
    plan = plan.where("chunk IS NOT NULL")
    rows = fx.turns(spark, sf_dir).where("role = 'user'").select(
        "conv_id", "turn", F.explode(F.array(F.lit("sft"), F.lit("dpo"))).alias("alg"), F.expr("concat('chunk', conv_id % 4 + 1)").alias("chunk")
    )
    runs = stages.runs_of(plan)
    joined = stages.stage_rows(stages.with_run_numbers(plan, runs), rows, max_plan_rows=10)
    return stages.rows_of_datasets(joined, runs)
