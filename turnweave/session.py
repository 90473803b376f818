"""Session settings, shared folders and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"

SHUFFLE_BYTES = 256 << 20
HOTSPOT_METHOD_BYTES = 8000

# What goes to a Python worker at once; Spark's own bound is by rows, however long their texts are.
BATCH_BYTES = 8 << 20

# A side is only hinted for broadcast when it is known to hold no more rows than this.
BROADCAST_ROWS = 100_000


def configure(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply the SQL settings that results depend on, bound what Python holds, and size shuffles.

    Judge replies with a repeated key keep its last value; Spark rejects them by default. Rows go to
    Python in batches of at most ``BATCH_BYTES``, or one row.
    With ``input_bytes`` a shuffle starts from enough partitions for all of the input, about
    ``SHUFFLE_BYTES`` each; adaptive execution merges them where less arrives.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(HOTSPOT_METHOD_BYTES))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", f"{BATCH_BYTES}b")
    if input_bytes is not None:
        partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // SHUFFLE_BYTES))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(SHUFFLE_BYTES))
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not root:
        # Executors of a local-cluster may have temporary folders of their own.
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        root = tempfile.mkdtemp(prefix="turnweave-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the checkpoint root, for tables written between steps."""
    return f"{checkpoint_root(spark).rstrip('/')}/turnweave/{label}-{uuid.uuid4().hex}"


def clear_shared(spark: SparkSession) -> bool:
    """Delete everything this library wrote to the shared folder; results not yet stored elsewhere
    cannot be read any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark).rstrip('/')}/turnweave")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result once and read it back.

    Used after model calls: their output must not be computed again when a later
    branch or a lost executor asks for it.
    """
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the side has at most ``max_rows`` rows.

    Counting stops after ``max_rows + 1`` rows. A larger side is returned as it is,
    and Spark joins it by shuffle.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def local_table(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    """A small table of settings. Handed over as Arrow, it is part of the plan itself."""
    columns = {name: [row[name] for row in rows] for name in schema.names}
    return spark.createDataFrame(pa.table(columns), schema)
