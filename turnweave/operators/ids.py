"""Dense row numbers, and what is counted by them."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from itertools import accumulate
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.functions.numbers import floor_div
from turnweave.session import broadcast_if_small, checkpointed, local_table

ROW_BITS = 33  # monotonically_increasing_id: partition above, row within it below


def _first_ids(placed: DataFrame, *chunk: str) -> DataFrame:
    """Per chunk of rows what to add to ``_place`` to get dense ids over all chunks."""
    sizes = placed.groupBy(*chunk).agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    before = Window.orderBy(*chunk).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    return sizes.select(*chunk, (start - F.col("_first")).alias("_shift"))


def dense_ids(df: DataFrame, *keys: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows ``(keys, carry, id)`` with ids 0 … n−1 in key order.

    The keys are range-sorted and numbered within their partition; each partition then
    starts where the ones before it end. The numbering is checkpointed between the two
    steps, so a lost executor cannot change it. Prefer a key the data has: carry little,
    and join the rest by key.
    """
    placed = checkpointed(
        df.select(*keys, *carry)
        .orderBy(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    parted = placed.withColumn("_partition", F.shiftrightunsigned("_place", ROW_BITS))
    # One row per sort partition.
    shifts = F.broadcast(_first_ids(parted, "_partition"))
    return parted.join(shifts, "_partition").select(
        *keys, *carry, (F.col("_place") + F.col("_shift")).alias("id")
    )


def file_order_ids(df: DataFrame) -> DataFrame:
    """Rows of a file scan with ``id`` 0 … n−1 in the order of files and lines.

    Lines of one split are read in order, so nothing is sorted or shuffled: only the
    first id of each split has to be found.
    """
    placed = checkpointed(
        df.select(
            "*",
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_place"),
        )
    )
    # One row per split.
    shifts = broadcast_if_small(_first_ids(placed, "_file", "_block"))
    return placed.join(shifts, ["_file", "_block"]).select(
        (F.col("_place") + F.col("_shift")).alias("id"), *df.columns
    )


def _of_splits(rows: DataFrame, numbers: Iterable[int]):
    """The JVM's row RDD of some partitions of a scan; the other partitions are not opened."""
    jvm = rows.sparkSession._jvm
    # A Scala set is the function that tells its members.
    wanted = jvm.PythonUtils.toSeq(list(numbers)).toSet()
    return jvm.org.apache.spark.rdd.PartitionPruningRDD.create(rows._jdf.toJavaRDD().rdd(), wanted).toJavaRDD()


def _as_frame(rdd, rows: DataFrame) -> DataFrame:
    """Rows of an RDD of the JVM with the columns of ``rows``."""
    spark = rows.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(rdd, rows._jdf.schema()), spark)


def _first_sizes(rows: DataFrame, wanted: int) -> list[int]:
    """Row counts of a scan's first partitions, as many as hold ``wanted`` rows, or all of them.

    A count stops at ``wanted``. Partitions are counted in waves that grow fourfold, as ``take()`` does.
    """
    splits = rows._jdf.toJavaRDD().getNumPartitions()
    sizes: list[int] = []
    wave, found = 1, 0

    def count(batches):
        size = 0
        for batch in batches:
            size += batch.num_rows
            if size >= wanted:
                break
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([min(size, wanted)], pa.int64())], ["part", "size"])

    while found < wanted and len(sizes) < splits:
        upto = min(splits, len(sizes) + wave)
        some = _as_frame(_of_splits(rows, range(len(sizes), upto)), rows).select(F.lit(0))
        counted = {row.part: row.size for row in some.mapInArrow(count, "part int, size long").collect()}
        for part in range(upto - len(sizes)):
            if found < wanted:
                sizes.append(counted.get(part, 0))
                found += sizes[-1]
        wave = 4 * wave
    return sizes


def first_of_files(spark: SparkSession, files: Sequence[str], read: Callable[[str], DataFrame], limit: int) -> DataFrame:
    """The first ``limit`` rows in the order of files and lines, with ``id`` from 0.

    Files are opened one after another until there are enough rows, and of each only its first splits,
    which are counted in order. Only the counts come to the driver: rows are numbered in the task that
    reads their split, and the last split is read as far as it is needed. Nothing is written.
    """
    chosen, sizes = [], []
    for file in files:
        found = sum(sizes)
        if found >= limit:
            break
        rows = read(file)
        some = _first_sizes(rows, limit - found)
        if some:
            chosen.append((rows, len(some)))
            sizes += some
    if not sum(sizes):
        return read(list(files)).limit(0).select(F.lit(0).cast("bigint").alias("id"), "*")
    starts = [0, *accumulate(sizes)]
    rows, count = chosen.pop()
    place = F.monotonically_increasing_id()
    last = _as_frame(_of_splits(rows, [count - 1]), rows)
    last = last.select((place + F.lit(starts[-2])).alias("id"), "*").limit(limit - starts[-2])
    chosen.append((rows, count - 1))
    whole = [_of_splits(x, range(n)) for x, n in chosen if n]
    if not whole:
        return last
    placed = _as_frame(spark._jsc.union(_java_array(spark, whole)), rows).select(place.alias("_place"), "*")
    parted = placed.withColumn("_partition", F.shiftrightunsigned("_place", ROW_BITS))
    shifts = [{"_partition": i, "_shift": start - (i << ROW_BITS)} for i, start in enumerate(starts[:-2])]
    kinds = T.StructType([T.StructField("_partition", T.LongType()), T.StructField("_shift", T.LongType())])
    # One row per split.
    numbered = parted.join(broadcast_if_small(local_table(spark, shifts, kinds)), "_partition")
    return numbered.select((F.col("_place") + F.col("_shift")).alias("id"), *rows.columns).unionByName(last)


def _java_array(spark: SparkSession, values: list):
    """RDDs as the array that the JVM's union takes."""
    out = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.spark.api.java.JavaRDD, len(values))
    for i, value in enumerate(values):
        out[i] = value
    return out


def zip_by_id(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    """Pair rows of two sides that share a key; rows without a partner fall away."""
    return left.join(right, key, "inner")


def first_rows(df: DataFrame, limit: int | None, *keys: str) -> DataFrame:
    """The first ``limit`` rows in key order, all of them for ``None``."""
    return df if limit is None else df.orderBy(*keys).limit(limit)


#: Rows for one task of a step that takes long for each row.
TASK_ROWS = 250_000


def dealt_by_rows(df: DataFrame, key: str = "id") -> tuple[DataFrame, int]:
    """The rows, and how many there are; dealt anew by ``key`` if a partition holds twice ``TASK_ROWS`` or more.

    For rows out of a sort, before a step that takes long for each of them: equal keys are sorted by one task,
    and Spark merges partitions by their compressed bytes, which are few for narrow rows and fewer for equal
    ones. Counting reads ``df`` once and brings one number a partition to the driver.
    """
    counts = df.groupBy(F.spark_partition_id().alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    sizes = [r["_rows"] for r in counts.collect()]
    if max(sizes, default=0) < 2 * TASK_ROWS:
        return df, sum(sizes)
    return df.repartition(-(-sum(sizes) // TASK_ROWS), key), sum(sizes)


def with_epochs(df: DataFrame, epochs: int) -> DataFrame:
    """Each row once per epoch, 1 … ``epochs``."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))


#: Rounds of a permutation, and how often a place outside the table is permuted again.
SHUFFLE_ROUNDS, SHUFFLE_WALK = 4, 20


def _permuted(place: Column, n: int, seed: Column) -> Column:
    """One pass of a keyed permutation of the numbers below the product of two sizes that hold ``n``."""
    rows, columns = shuffle_sizes(n)
    left, right = floor_div(place, columns), place % columns
    for step in range(SHUFFLE_ROUNDS):
        fixed = left if step % 2 else right
        digest = F.md5(F.concat_ws("|", seed, F.lit(str(step)), fixed.cast("string")).cast("binary"))
        moved = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
        if step % 2:
            right = (right + moved) % columns
        else:
            left = (left + moved) % rows
    return left * columns + right


def shuffle_sizes(n: int) -> tuple[int, int]:
    """Two numbers of about the same size whose product is at least ``n``, by less than the first."""
    rows = max(1, isqrt(n))
    return rows, -(-n // rows)


def with_epoch_order(df: DataFrame, n: int, row: str = "id", epoch: str = "epoch", seed: int = 0) -> DataFrame:
    """Add ``place``: the place of each of the rows numbered 0 … ``n``−1 in the order of its epoch.

    A permutation of the numbers under a key of seed and epoch, so each epoch has an order of its own and
    nothing is sorted or shuffled. Numbers that land beyond ``n`` are permuted again until they do not;
    as fewer than the square root of ``n`` do, ``SHUFFLE_WALK`` times are enough. Only these rows go through
    the loop, which Spark does not compile; what all rows need is a column before it, computed once a row.
    """
    key = F.concat_ws("|", F.lit(str(seed)), F.col(epoch).cast("string"))

    def again(place: Column, _: Column) -> Column:
        return F.when(place >= n, _permuted(place, n, key)).otherwise(place)

    first = F.col("_first")
    failed = F.raise_error(F.lit("no place found in the order of the epoch")).cast("bigint")
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(SHUFFLE_WALK)), first, again, lambda place: F.when(place < n, place).otherwise(failed))
    permuted = df.withColumn("_first", _permuted(F.col(row).cast("bigint"), n, key))
    return permuted.withColumn("place", F.when(first < n, first).otherwise(walked)).drop("_first")


def with_batches(df: DataFrame, batch_size: int = 64, mini_batch_size: int = 16, row: str = "id") -> DataFrame:
    """Batch, and mini-batch within it, of rows numbered by ``row``. The last is short."""
    if batch_size % mini_batch_size:
        raise ValueError("batch_size must be a multiple of mini_batch_size")
    place = F.col(row) % batch_size
    return df.withColumns(
        {
            "batch": floor_div(F.col(row), batch_size),
            "mini_batch": floor_div(place, mini_batch_size),
        }
    )


def steps_per_epoch(
    df: DataFrame, micro_batch_size: int, accumulation: int = 1, workers: int = 1
) -> DataFrame:
    """Row count and optimiser steps of one pass over the data."""
    per_step = micro_batch_size * accumulation * workers
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "steps", F.ceil(F.col("n_rows") / F.lit(per_step)).cast("bigint")
    )
