"""Outputs of one file each, in the order of a key.

Rows are sorted and rendered by many tasks; once it is known how many bytes each of them has made, every piece
is written at its own place of one file, again by many tasks. No byte passes the driver, and a task that is run
again writes the same bytes to the same place. The file appears under its name when it is whole; a
failed job leaves nothing. The folder has to be mounted on driver and executors.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.schemas import SUMMARY
from turnweave.session import materialize

PIECE_BYTES = 1 << 20

PIECES = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("data", T.BinaryType())]
)


def json_line(row: dict) -> str:
    return json.dumps(row, ensure_ascii=False)


def _plain(value: object, kind: T.DataType) -> object:
    """Arrow's plain values with maps as dictionaries, at any depth."""
    if value is None:
        return None
    if isinstance(kind, T.MapType):
        return {k: _plain(v, kind.valueType) for k, v in value}
    if isinstance(kind, T.StructType):
        return {f.name: _plain(value[f.name], f.dataType) for f in kind}
    if isinstance(kind, T.ArrayType):
        return [_plain(v, kind.elementType) for v in value]
    return value


def _local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def write_one_file(df: DataFrame, path: str, *order: str, render: Callable[[dict], str] = json_line) -> int:
    """Write each row as a line of one file, in the order of its columns ``order``; the number of bytes.

    What was at the path is replaced. Rows of an equal key are in any order; an empty table makes an empty file.
    """
    schema, path = df.schema, _local(path)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, start, held, size = TaskContext.get().partitionId(), 0, [], 0

        def piece() -> pa.RecordBatch:
            columns = [pa.array([part], pa.int32()), pa.array([start], pa.int64()), pa.array([b"".join(held)], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, PIECES.names)

        for batch in batches:
            for row in batch.to_pylist():
                line = f"{render(_plain(row, schema))}\n".encode()
                held.append(line)
                size += len(line)
                if size >= PIECE_BYTES:
                    yield piece()
                    start, held, size = start + size, [], 0
        if held:
            yield piece()

    pieces = materialize(df.orderBy(*order).mapInArrow(make, PIECES), "pieces-of-file")
    sizes = pieces.groupBy("part").agg(F.sum(F.octet_length("data")).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per sort partition.
    places = materialize(sizes.select("part", "size", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("begin")), "places-in-file")
    total = places.agg(F.sum("size")).first()[0] or 0
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    unfinished = f"{path}.{uuid.uuid4().hex}"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = os.open(unfinished, os.O_WRONLY)
        try:
            for batch in batches:
                for at, data in zip(batch.column("at").to_pylist(), batch.column("data").to_pylist()):
                    view = memoryview(data)
                    while view:
                        done = os.pwrite(file, view, at)
                        view, at = view[done:], at + done
                yield pa.RecordBatch.from_arrays([pa.array([sum(map(len, batch.column("data").to_pylist()))], pa.int64())], ["n"])
            os.fsync(file)
        finally:
            os.close(file)

    try:
        with open(unfinished, "wb") as file:
            file.truncate(total)
        placed = pieces.join(F.broadcast(places), "part").select((F.col("begin") + F.col("start")).alias("at"), "data")
        written = placed.mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
        if written != total:
            raise OSError(f"{written} of {total} bytes were written to {path}")
        os.replace(unfinished, path)
    except BaseException:
        if os.path.exists(unfinished):
            os.remove(unfinished)
        raise
    return total


def write_predictions_file(predictions: DataFrame, path: str) -> int:
    return write_one_file(predictions.select("id", "query", "completion"), path, "id")


def write_judge_results_file(results: DataFrame, path: str) -> int:
    return write_one_file(results.select("scores", "reasons", "id", "overall"), path, "id")


def write_summary_file(summary: DataFrame, path: str) -> None:
    """The summary of one run as one indented object."""
    names = [f.name for f in SUMMARY]
    rows = summary.select(*names).limit(2).toArrow().to_pylist()
    if len(rows) != 1:
        raise ValueError("a summary file holds one run")
    kinds = {f.name: f.dataType for f in summary.schema}
    path = _local(path)
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    unfinished = f"{path}.{uuid.uuid4().hex}"
    with open(unfinished, "w", encoding="utf-8") as file:
        json.dump({n: _plain(rows[0][n], kinds[n]) for n in names}, file, indent=2)
    os.replace(unfinished, path)
