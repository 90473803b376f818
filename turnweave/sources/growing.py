"""Logs that grow in place, as a stream.

A streaming data source whose offset says, for every log, how many of its bytes were read. A log
is known by device and inode, so it is the same one after it was renamed by rotation, and the new
one under its old name starts at byte 0. Lines are handed out once they end; what follows the last
line end waits for the next trigger. Offsets are kept in the query's checkpoint like those of any
other source, so a restarted query goes on where it stopped.

The folder must be mounted on the driver and the executors, as job logs on a cluster's file
system are.
"""

from __future__ import annotations

import glob
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "growing_logs"
SCHEMA = "run_id string, log string, position long, value string"
#: Bytes that one task reads.
SPLIT_BYTES = 64 << 20
#: Bytes looked at in one go.
BLOCK_BYTES = 1 << 20
#: Lines of a batch that is handed to Spark.
BATCH_LINES = 4096


@dataclass
class Span(InputPartition):
    """The lines of a log that begin in ``[first, end)``; ``start`` is where unread ones begin."""

    run: str
    log: str
    path: str
    pattern: str
    start: int
    first: int
    end: int


def identity(status: os.stat_result) -> str:
    return f"{status.st_dev}:{status.st_ino}"


def logs_of(pattern: str) -> dict[str, tuple[str, int]]:
    """Path and size of each log, by identity. A log under several names counts once."""
    found = {}
    for path in sorted(glob.glob(pattern)):
        try:
            status = os.stat(path)
        except FileNotFoundError:  # rotated away since it was listed
            continue
        if os.path.isfile(path):
            found.setdefault(identity(status), (path, status.st_size))
    return found


def complete_upto(path: str, log: str, start: int, size: int) -> int:
    """Where the last line that ends within ``size`` bytes ends; ``start`` if there is none behind it."""
    with open(path, "rb") as file:
        if identity(os.fstat(file.fileno())) != log:
            return start
        end = size
        while end > start:
            begin = max(start, end - BLOCK_BYTES)
            file.seek(begin)
            at = file.read(end - begin).rfind(b"\n")
            if at >= 0:
                return begin + at + 1
            end = begin
    return start


class GrowingLogs(DataSource):
    """``{runs}/{run_id}/{log}`` files as rows ``(run_id, log, position, value)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return GrowingLogReader(self.options)


class GrowingLogReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        if "path" not in options:
            raise ValueError("growing logs need a path")
        self.pattern = options["path"].removeprefix("file://").removeprefix("file:")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.ends: dict[str, int] = {}

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """How far every log that is there can be read. A log that is gone leaves the offset."""
        ends = {}
        for log, (path, size) in logs_of(self.pattern).items():
            seen = self.ends.get(log, 0)
            try:
                # A log that is shorter than before was emptied: it begins anew.
                ends[log] = complete_upto(path, log, seen if seen <= size else 0, size)
            except FileNotFoundError:
                continue
        self.ends = ends
        return dict(sorted(ends.items()))

    def partitions(self, start: dict, end: dict) -> list[Span]:
        paths = {log: path for log, (path, _) in logs_of(self.pattern).items()}
        spans = []
        for log, upto in end.items():
            begin = start.get(log, 0)
            begin = begin if begin <= upto else 0
            if begin < upto and log not in paths:
                raise FileNotFoundError(f"log {log} is gone before its lines up to {upto} were read")
            for first in range(begin, upto, self.split):
                run = os.path.basename(os.path.dirname(paths[log]))
                spans.append(Span(run, log, paths[log], self.pattern, begin, first, min(upto, first + self.split)))
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        path = partition.path
        try:
            same = identity(os.stat(path)) == partition.log
        except FileNotFoundError:
            same = False
        if not same:  # renamed since the batch was planned
            path = logs_of(partition.pattern).get(partition.log, (None, 0))[0]
            if path is None:
                raise FileNotFoundError(f"log {partition.log}, once {partition.path}, is gone")
        with open(path, "rb") as file:
            at = partition.first
            if at > partition.start:
                # The line that runs into this span belongs to the one before.
                file.seek(at - 1)
                at += len(file.readline()) - 1
            file.seek(at)
            held: list[tuple[int, str]] = []
            while at < partition.end:
                line = file.readline()
                held.append((at, line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace")))
                at += len(line)
                if len(held) == BATCH_LINES or not line:
                    yield self._batch(partition, held)
                    held = []
                if not line:
                    break
            if held:
                yield self._batch(partition, held)

    @staticmethod
    def _batch(partition: Span, held: list[tuple[int, str]]) -> pa.RecordBatch:
        n = len(held)
        columns = [pa.array([partition.run] * n), pa.array([partition.log] * n), pa.array([p for p, _ in held], pa.int64()), pa.array([v for _, v in held])]
        return pa.RecordBatch.from_arrays(columns, ["run_id", "log", "position", "value"])

    def commit(self, end: dict) -> None:
        """Nothing is kept besides the query's own checkpoint."""


def follow_logs(spark: SparkSession, pattern: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Lines of ``{runs}/{run_id}/{log}`` files that match ``pattern``, as they are appended.

    Rows ``(run_id, log, position, value)``; ``log`` stays the same through rotation by renaming and
    ``position`` is the byte at which the line begins, so both order the lines of a log. The pattern
    must also match rotated names as long as they hold unread lines. A log that was emptied in
    place is read from its start again.
    """
    spark.dataSource.register(GrowingLogs)
    return spark.readStream.format(FORMAT).option("path", pattern).option("splitBytes", split_bytes).load()
