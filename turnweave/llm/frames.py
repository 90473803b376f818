"""Small helpers for operators that add columns in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Made = dict[str, pa.Array]

#: What goes to a Python worker at once. Spark's own bound is by rows, however long their texts are.
BATCH_BYTES = 8 << 20


def bounded_batches(df: DataFrame) -> DataFrame:
    """Have the session hand rows to Python in batches of at most ``BATCH_BYTES``, or one row."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    return df


def by_place(df: DataFrame) -> DataFrame:
    """The same columns named ``c0``, ``c1`` and so on, so that none can clash with an added one."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def kept_columns(df: DataFrame, added: T.StructType, text: str) -> list[str]:
    """The columns that stay; an added column takes the place of one of the same name,
    in any case of letters."""
    names = {name.lower() for name in added.names}
    return [c for c in df.columns if c.lower() not in names or c == text]


def with_arrow_columns(
    df: DataFrame,
    text: str,
    added: T.StructType,
    make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.RecordBatch, Made]]],
) -> DataFrame:
    """Add columns that ``make`` derives from batches; it yields rows and their new columns."""
    keep = [c for c in kept_columns(df, added, text) if c not in added.names]
    read = list(dict.fromkeys([*keep, text]))
    schema = T.StructType([*(df.schema[c] for c in keep), *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, made in make(batches):
            columns = [batch.column(c) for c in keep] + [made[c] for c in added.names]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *added.names])

    return bounded_batches(df).select(*[F.col(f"`{c}`") for c in read]).mapInArrow(run, schema)
