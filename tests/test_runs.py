"""Stage plans, run logs, streams, session helpers."""

import pytest
from pyspark.sql import functions as F

from turnweave import session
from turnweave.operators import outcomes
from turnweave.plans import stages
from turnweave.sources.logs import stream_run_logs
from turnweave.streaming import runs


def plan_of(spark, masks, datasets=stages.DEFAULT_DATASETS):
    frame = spark.createDataFrame([("e", masks)], "experiment string, masks array<int>")
    plan = stages.stage_plan(stages.series_of(frame), "init", "T", "pre", "/runs")
    return plan, stages.dataset_manifest(spark, datasets)


def test_default_plan(spark):
    plan, manifest = plan_of(spark, list(stages.DEFAULT_MASKS))
    rows = stages.with_datasets(plan, manifest).orderBy("series", "stage").collect()
    assert [(r.series, r["mask"], r.stage, r.alg, r.dataset_idx, r.chunk) for r in rows] == [
        (1, 0, 0, "sft", 0, "chunk1"),
        (1, 0, 1, "sft", 1, "chunk2"),
        (1, 0, 2, "sft", 2, "chunk4"),
        (2, 6, 0, "sft", 0, "chunk1"),
        (2, 6, 1, "dpo", 0, "chunk2"),
        (2, 6, 2, "dpo", 1, "chunk4"),
    ]
    assert rows[4].run_id == "pre_m6_T_s2_stage1_dpo_T"
    assert [r.base_model for r in rows[3:]] == [
        "init",
        "/runs/pre_m6_T_s2_stage0_sft_T",
        "/runs/pre_m6_T_s2_stage1_dpo_T",
    ]


def test_plan_needs_no_shuffle(spark):
    plan, _ = plan_of(spark, [1, 2])
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_missing_datasets(spark):
    plan, manifest = plan_of(spark, [2, 4], stages.DEFAULT_DATASETS[:3])
    missing = stages.missing_datasets(plan, manifest).orderBy("series").collect()
    assert [(r.series, r.stage, r.alg) for r in missing] == [(1, 1, "dpo"), (2, 2, "dpo")]


def test_outcomes(spark):
    lines = [
        ("a", 1, "step"),
        ("a", 2, "x Model successfully saved to /m"),
        ("a", 3, "Model successfully saved to /n"),
        ("b", 1, "[WATCHER] Model successfully saved to /m"),
        ("b", 2, "model successfully saved to /m"),
        ("c", 1, "note: [WATCHER] Model successfully saved to /m"),
    ]
    frame = spark.createDataFrame(lines, "run_id string, line_no long, value string")
    finished = outcomes.finished_runs(frame)
    assert {r.run_id: r.line_no for r in finished.collect()} == {"a": 2, "c": 1}
    judged = outcomes.run_outcomes(frame.select("run_id").distinct(), finished)
    assert dict(tuple(r) for r in judged.collect()) == {"a": "success", "b": "failure", "c": "success"}
    quiet = outcomes.without_noise(
        spark.createDataFrame([(f"W {outcomes.NOISE}.",), ("kept",)], "value string")
    )
    assert [r.value for r in quiet.collect()] == ["kept"]


def test_log_stream_reports_each_run_once(spark, tmp_path):
    logs = tmp_path / "runs"
    for run, chunk, text in [
        ("r1", "run.log.0", "start\nModel successfully saved to /a\nModel successfully saved to /a\n"),
        ("r1", "run.log.1", "Model successfully saved to /b\n"),
        ("r2", "run.log.0", "[WATCHER] Model successfully saved to /c\nstep\n"),
    ]:
        (logs / run).mkdir(parents=True, exist_ok=True)
        (logs / run / chunk).write_text(text)
    sink, progress = str(tmp_path / "sink"), str(tmp_path / "progress")

    def run_stream():
        runs.write_available(runs.completions(stream_run_logs(spark, f"{logs}/*", 2)), sink, progress)
        return sorted(r.run_id for r in spark.read.parquet(sink).collect())

    assert run_stream() == ["r1"]
    # A later chunk: r2 is new, r1 was reported before.
    (logs / "r2" / "run.log.1").write_text("Model successfully saved to /c\n")
    (logs / "r1" / "run.log.2").write_text("Model successfully saved to /a\n")
    assert run_stream() == ["r1", "r2"]


def test_broadcast_only_when_small(spark):
    frame = spark.range(50).select((F.col("id") % 7).alias("k"))

    def hinted(max_rows):
        joined = spark.range(5).join(session.broadcast_if_small(frame, max_rows), F.col("id") == F.col("k"))
        return "strategy=broadcast" in joined._jdf.queryExecution().logical().toString()

    assert hinted(50) and not hinted(49)


def test_shared_folder_follows_the_session(spark, tmp_path):
    named = spark.conf.get(session.CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    root = session.checkpoint_root(spark)
    assert named is None or root == named
    one, two = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert one != two and one.startswith(root)


def test_materialized_rows_are_not_computed_again(spark):
    noisy = spark.range(20).select("id", F.rand().alias("r"))
    kept = session.materialize(noisy, "noisy")
    assert kept.orderBy("id").collect() == kept.orderBy("id").collect()
    assert kept.schema == noisy.schema or kept.columns == noisy.columns


def test_checkpoint_keeps_rows(spark):
    assert session.checkpointed(spark.range(5)).count() == 5


def test_shuffles_sized_by_input(spark):
    names = [
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
    ]
    fresh = spark.newSession()
    session.configure(fresh, 100 << 40)
    assert [fresh.conf.get(n) for n in names] == [str((100 << 40) // session.SHUFFLE_BYTES), str(256 << 20)]
    session.configure(fresh, 10)
    assert fresh.conf.get(names[0]) == fresh.conf.get("spark.sql.shuffle.partitions")
