"""Runs that report a saved model, or do not before their time is up.

Reports are looked for as lines arrive; timers on the time of the lines tell when a run's time is up.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from turnweave.operators.outcomes import SAVED, WATCHER

STORE_SETTING = "spark.sql.streaming.stateStore.providerClass"
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

OUTCOMES = T.StructType(
    [T.StructField("run_id", T.StringType()), T.StructField("outcome", T.StringType()), T.StructField("at_ms", T.LongType())]
)


class Deadlines(StatefulProcessor):
    """``success`` at a run's first report, ``failure`` once the watermark passes its deadline."""

    def __init__(self, within_ms: int):
        self.within_ms = within_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "deadline long, closed boolean, last long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first, last, reported = [], [], []
        for frame in rows:
            first.append(int(frame["at_ms"].min()))
            last.append(int(frame["at_ms"].max()))
            reported += [int(x) for x in frame.loc[frame["saved"], "at_ms"].nsmallest(1)]
        if self.run.exists():
            deadline, closed, before = self.run.get()
            last.append(before)
        else:
            deadline, closed = min(first) + self.within_ms, False
            self.handle.registerTimer(deadline)
        success = not closed and bool(reported) and min(reported) <= deadline
        self.run.update((deadline, closed or success, max(last)))
        if success:
            yield self.outcome(key, "success", min(reported))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        deadline, closed, last = self.run.get()
        silent = last + self.within_ms
        if silent > expiredTimerInfo.getExpiryTimeInMs():
            # Still writing: its outcome is remembered until it has been silent as long as it had time.
            self.run.update((deadline, True, last))
            self.handle.registerTimer(silent)
        else:
            self.run.clear()
        if not closed:
            yield self.outcome(key, "failure", deadline)

    @staticmethod
    def outcome(key, outcome: str, at_ms: int) -> pd.DataFrame:
        return pd.DataFrame({"run_id": [key[0]], "outcome": [outcome], "at_ms": [at_ms]})

    def close(self) -> None:
        pass


def judged_runs(lines: DataFrame, time: str, within_seconds: int, late: str, run: str = "run_id") -> DataFrame:
    """One row ``(run_id, outcome, at)`` per run of a stream of ``lines`` with a ``value`` and a ``time``.

    A run's time begins with its first line and lasts ``within_seconds``. At its first report within
    that time it is a ``success``, at the time of the report; once the watermark, ``late`` behind the
    newest line, has passed its deadline without one, a ``failure``, at the deadline. Repeated and later
    reports change nothing. State is one small row per run; it goes once the run has its outcome and has
    been silent for ``within_seconds``. Lines behind the watermark are dropped by Spark, and so are
    those without a time.
    """
    spark = lines.sparkSession
    if spark.conf.get(STORE_SETTING, None) != STORE:
        raise ValueError(f"set {STORE_SETTING} to {STORE}")
    text = F.coalesce("value", F.lit(""))
    narrow = lines.where(F.col(time).isNotNull()).withWatermark(time, late).select(
        F.col(run).cast("string").alias("run_id"),
        F.col(time).alias("line_time"),
        F.unix_millis(F.col(time)).alias("at_ms"),
        (~text.startswith(WATCHER) & text.contains(SAVED)).alias("saved"),
    )
    judged = narrow.groupBy("run_id").transformWithStateInPandas(Deadlines(within_seconds * 1000), OUTCOMES, outputMode="append", timeMode="EventTime")
    return judged.select("run_id", "outcome", F.timestamp_millis("at_ms").alias("at"))
