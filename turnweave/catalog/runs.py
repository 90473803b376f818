"""Run logs, in batch and as streams."""

import os

from pyspark.sql import functions as F

from turnweave.catalog import fixtures as fx
from turnweave.catalog.registry import query
from turnweave.functions.numbers import floor_div
from turnweave.operators import outcomes
from turnweave.session import shared_folder
from turnweave.sources.growing import follow_logs
from turnweave.sources.logs import stream_run_logs
from turnweave.streaming import deadlines, runs

LINES = f"({fx.SQL_LOG_LINES})"
SAVED = "contains(value, 'Model successfully saved to') AND NOT starts_with(value, '[WATCHER]')"
NOISE = "contains(value, 'Caching is incompatible with gradient checkpointing')"


def _lines(spark, sf_dir):
    return fx.log_lines(fx.table(spark, sf_dir, "events"))


def _stream(spark, sf_dir):
    """The same lines as a stream over the files of the table.

    The braces make the path a pattern, which may name a file as well as a folder.
    """
    schema = fx.table(spark, sf_dir, "events").schema
    return fx.log_lines(spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet"))


def _streamed(stream, label):
    """Run a stream over what is there and read what it wrote."""
    spark = stream.sparkSession
    folder = shared_folder(spark, label)
    runs.write_available(stream, f"{folder}/rows", f"{folder}/progress")
    return spark.read.schema(stream.schema).parquet(f"{folder}/rows")


@query(f"SELECT run_id, line_no, value FROM {LINES} WHERE {SAVED}")
def saved_lines(spark, sf_dir):
    return outcomes.saved_lines(_lines(spark, sf_dir))


@query(f"SELECT DISTINCT run_id FROM {LINES} WHERE {SAVED}")
def run_completion(spark, sf_dir):
    return _streamed(runs.completions(_stream(spark, sf_dir)), "run-completion")


LOGGED_RUNS, CHUNK_LINES = 50, 100_000


@query(f"SELECT DISTINCT CAST(run_id % {LOGGED_RUNS} AS VARCHAR) AS run_id FROM {LINES} WHERE {SAVED}")
def run_log_stream(spark, sf_dir):
    """The same from text files, one folder of rolled chunks per run."""
    folder = shared_folder(spark, "run-logs")
    logs = _lines(spark, sf_dir).select(
        (F.col("run_id") % LOGGED_RUNS).alias("run"),
        floor_div(F.col("line_no"), CHUNK_LINES).alias("chunk"),
        "value",
    )
    landed = logs.repartition("run", "chunk").select("run", "value")
    landed.write.partitionBy("run").text(folder)
    stream = stream_run_logs(spark, f"{folder}/*").withColumn(
        "run_id", F.substring_index("run_id", "=", -1)
    )
    return _streamed(runs.completions(stream), "run-log-completion")


@query(
    f"""SELECT run_id, min(line_no) AS line_no, min_by(value, line_no) AS value
FROM {LINES} WHERE {SAVED} GROUP BY run_id"""
)
def run_first_completion(spark, sf_dir):
    return outcomes.finished_runs(_lines(spark, sf_dir))


@query(
    f"""SELECT run_id, CASE WHEN bool_or({SAVED}) THEN 'success' ELSE 'failure' END AS outcome
FROM {LINES} GROUP BY run_id"""
)
def run_outcome(spark, sf_dir):
    finished = _streamed(runs.completions(_stream(spark, sf_dir)), "run-outcome")
    known = _lines(spark, sf_dir).select("run_id").distinct()
    return outcomes.run_outcomes(known, finished)


@query(
    f"""SELECT run_id, day, CASE WHEN bool_or({SAVED}) THEN 'success' ELSE 'failure' END AS outcome
FROM (SELECT user_id AS run_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {fx.LOG_LINE} AS value FROM events)
GROUP BY run_id, day"""
)
def run_outcome_daily(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    lines = events.select(
        F.struct("user_id", F.to_date("ts").cast("string").alias("day")).alias("run_id"),
        F.col("event_id").alias("line_no"),
        F.expr(fx.LOG_LINE).alias("value"),
    )
    known = lines.select("run_id").distinct()
    judged = outcomes.run_outcomes(known, outcomes.finished_runs(lines))
    return judged.select(F.col("run_id.user_id").alias("run_id"), "run_id.day", "outcome")


@query(f"SELECT run_id, line_no, value FROM {LINES} WHERE NOT {NOISE}")
def log_noise_filter(spark, sf_dir):
    return outcomes.without_noise(_lines(spark, sf_dir))


@query(f"SELECT run_id, line_no, value FROM {LINES} WHERE NOT {NOISE}")
def log_noise_filter_stream(spark, sf_dir):
    return _streamed(outcomes.without_noise(_stream(spark, sf_dir)), "log-lines")


GROWN_RUNS = 16


def _append(folder):
    """Appends each run's lines to its log, as the task that has them."""

    def write(frames):
        for frame in frames:
            for run, lines in frame.groupby("run", sort=False):
                place = f"{folder}/{run}"
                os.makedirs(place, exist_ok=True)
                with open(f"{place}/run.log", "a", encoding="utf-8") as log:
                    log.writelines(f"{line}\n" for line in lines["value"])
            yield frame[["run"]].head(0)

    return write


@query(f"SELECT CAST(run_id % {GROWN_RUNS} AS VARCHAR) AS run_id, value FROM {LINES}")
def growing_log_stream(spark, sf_dir):
    """Lines of logs that grow in place: two appends, then a rotation, with the stream stopped and
    started again from its checkpoint after each."""
    folder = shared_folder(spark, "growing-logs")
    logs, rows, progress = (f"{folder}/{name}" for name in ("logs", "rows", "progress"))
    plain = logs.removeprefix("file://").removeprefix("file:")
    lines = _lines(spark, sf_dir).select((F.col("run_id") % GROWN_RUNS).alias("run"), "line_no", "value")
    for third in range(3):
        some = lines.where(F.col("line_no") % 3 == third).repartition("run").sortWithinPartitions("run", "line_no")
        written = some.select("run", "value").mapInPandas((_append if third < 2 else _rotated)(plain), "run long")
        written.write.format("noop").mode("overwrite").save()
        stream = follow_logs(spark, f"{plain}/*/run.log*", split_bytes=1 << 16).select("run_id", "value")
        runs.write_available(stream, rows, progress)
    return spark.read.schema("run_id string, value string").parquet(rows)


def _rotated(folder):
    """The same, with each log renamed once before its first line."""
    append = _append(folder)

    def write(frames):
        renamed = set()
        for frame in frames:
            for run in frame["run"].unique():
                if run not in renamed and os.path.exists(f"{folder}/{run}/run.log"):
                    os.rename(f"{folder}/{run}/run.log", f"{folder}/{run}/run.log.1")
                renamed.add(run)
            yield from append([frame])

    return write


@query(f"SELECT DISTINCT run_id FROM {LINES} WHERE {SAVED}")
def run_completion_timed(spark, sf_dir):
    """The same as ``run_completion`` with a time column, so that state is forgotten."""
    schema = fx.table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).parquet(f"{sf_dir}/{{events}}.parquet")
    lines = events.select(F.col("user_id").alias("run_id"), F.col("ts").cast("timestamp").alias("at"), F.expr(fx.LOG_LINE).alias("value"))
    return _streamed(runs.completions(lines, time="at", within="1 hour"), "run-completion-timed")


DAILY_RUNS, WITHIN, LATE = 50, 6 * 3600, 3600


@query(
    f"""WITH l AS (SELECT CAST(user_id % {DAILY_RUNS} AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS run_id, epoch_ms(ts) AS t, {fx.LOG_LINE} AS value FROM events),
r AS (SELECT run_id, min(t) + {1000 * WITHIN} AS deadline, min(t) FILTER ({SAVED}) AS rep FROM l GROUP BY run_id)
SELECT run_id, CASE WHEN rep <= deadline THEN 'success' ELSE 'failure' END AS outcome,
  strftime(make_timestamp(1000 * CASE WHEN rep <= deadline THEN rep ELSE deadline END), '%Y-%m-%d %H:%M:%S') AS at
FROM r WHERE rep <= deadline OR deadline <= (SELECT max(t) - {1000 * LATE} FROM l)"""
)
def run_deadlines(spark, sf_dir):
    """Runs of a day that report within six hours, or fail when their time is up. Ten days land at a time,
    and the stream is started anew from its checkpoint for each."""
    folder = shared_folder(spark, "run-deadlines")
    events = fx.table(spark, sf_dir, "events")
    lines = events.select(
        F.concat_ws("-", F.col("user_id") % DAILY_RUNS, F.to_date("ts").cast("string")).alias("run_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.expr(fx.LOG_LINE).alias("value"),
    )
    before = spark.conf.get(deadlines.STORE_SETTING, None)
    spark.conf.set(deadlines.STORE_SETTING, deadlines.STORE)
    try:
        for third in range(3):
            some = lines.where(F.least(F.lit(2), F.floor((F.dayofmonth("ts") - 1) / 10)) == third)
            some.write.mode("append").parquet(f"{folder}/lines")
            stream = spark.readStream.schema(lines.schema).parquet(f"{folder}/lines")
            judged = deadlines.judged_runs(stream, "ts", WITHIN, f"{LATE} seconds")
            judged = judged.select("run_id", "outcome", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"))
            runs.write_available(judged, f"{folder}/rows", f"{folder}/progress")
    finally:
        if before is None:
            spark.conf.unset(deadlines.STORE_SETTING)
        else:
            spark.conf.set(deadlines.STORE_SETTING, before)
    return spark.read.schema("run_id string, outcome string, at string").parquet(f"{folder}/rows")
