"""Bottom-k sketches of word shingles as document fingerprints.

A fingerprint holds the ``K`` smallest 48-bit hashes of a text's distinct shingles, in order. That
of a text in parts is the ``K`` smallest of the parts' values, if shingles across the joints are
among them.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches, with_arrow_columns
from turnweave.llm.words import FOLDED, slices, words_of

K = 128
SHINGLE = 5
_SPACE = float(1 << 48)


def sketches(texts: pa.Array, k: int = K, shingle: int = SHINGLE) -> list[np.ndarray]:
    """For each text the ``k`` smallest shingle hashes; a shorter text is one shingle, an empty
    one or null has none."""
    words = words_of(texts, FOLDED)
    places, hashes = words.windows(shingle)
    hashes >>= np.uint64(16)
    first = np.searchsorted(places, words.first)
    whole, counts = words.whole() >> np.uint64(16), words.counts
    out = []
    for i in range(len(counts)):
        values = hashes[first[i] : first[i + 1]]
        if not len(values):
            values = whole[i : i + 1] if counts[i] else values
        elif len(values) > 4 * k:
            # Repeats may fill the smallest values; then all are looked at.
            low = np.unique(np.partition(values, 2 * k)[: 2 * k])
            values = low if len(low) >= k else values
        out.append(np.unique(values)[:k])
    return out


def encode(sketch: np.ndarray) -> str:
    """Eight characters for each value, in order."""
    return base64.b64encode(sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def decode(fingerprint: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8).reshape(-1, 6)
    return np.pad(raw, ((0, 0), (2, 0))).reshape(-1).view(">u8").astype(np.uint64)


def merge(sketches: Iterable[np.ndarray], k: int = K) -> np.ndarray:
    """The sketch of all shingles together."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *sketches]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of common shingles among all; exact below ``k`` shingles. Two empty texts are alike."""
    both = merge([a, b], k)
    if not len(both):
        return 1.0
    return np.count_nonzero(np.isin(both, a) & np.isin(both, b)) / len(both)


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below ``k``."""
    return float(len(a)) if len(a) < k else (k - 1) * _SPACE / float(a[k - 1] + np.uint64(1))


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the first one's shingles that the second has; 1 for an empty first one."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, k) * distinct_shingles(merge([a, b], k), k)
    return min(1.0, common / distinct_shingles(a, k))


RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint", k: int = K) -> DataFrame:
    """Add each text's fingerprint; empty for null and empty texts. Rows are not moved."""
    def make(batches):
        for batch in slices(batches, text):
            made = [encode(s) for s in sketches(batch.column(text), k)]
            yield batch, {name: pa.array(made, pa.string())}

    return with_arrow_columns(docs, text, T.StructType([T.StructField(name, T.StringType())]), make)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def dealt_in_order(docs: DataFrame, key: str, parts: int) -> DataFrame:
    """Rows by descending key in parts: ``_part``, ``_guest``, the key and the text.

    Each part also gets, as guests, the rows of the first key of the part after it; the last part
    those of the very first. Bounds come from quantiles of the keys and are bounded in number by
    the parts. Null keys come last.
    """
    bounds = np.unique(docs.approxQuantile(key, [i / parts for i in range(1, parts)], 1 / (4 * parts)) if parts > 1 else [])
    last = len(bounds)

    @F.pandas_udf("int")
    def part_of(keys):
        found = last - np.searchsorted(bounds, keys.to_numpy(float), side="right")
        return _series(np.where(keys.isna(), last, found))

    parted = docs.withColumn("_part", part_of(F.col(key).cast("double")))
    heads = parted.groupBy("_part").agg(F.max(key).alias("head"), F.count(F.lit(1)).alias("n")).collect()
    order = sorted(row._part for row in heads)
    head = {row._part: row.head for row in heads}
    guests = [(p, head[order[(i + 1) % len(order)]]) for i, p in enumerate(order)]
    hosts = docs.sparkSession.createDataFrame(guests, T.StructType([T.StructField("_host", T.IntegerType()), T.StructField("_head", docs.schema[key].dataType)]))
    own = parted.withColumn("_guest", F.lit(False))
    # One row per part; a guest's text goes to one part more.
    visiting = parted.join(F.broadcast(hosts), F.col(key).eqNullSafe(F.col("_head"))).select(
        *docs.columns, F.col("_host").alias("_part"), F.lit(True).alias("_guest")
    )
    return own.unionByName(visiting)


def _series(values: np.ndarray):
    return pd.Series(values.astype(np.int32))


def neighbour_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Fingerprints of each text, of its edited form and their likeness, also to the next document's.

    The next document follows by descending id, rows of equal ids by text; after the last comes the
    first, and a lone document follows itself. Null texts are empty ones, null ids come last. Equal
    rows each have their own result. No documents give no rows. Texts move once, to parts of neighbours.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    dealt = dealt_in_order(rows, "doc_id", 4 * tasks)
    ordered = dealt.repartition(tasks, "_part").sortWithinPartitions("_part", "_guest", F.desc_nulls_last("doc_id"), "text")

    def run(batches):
        held = None  # the last row whose next one is not known yet
        guest_of = None  # the part whose first guest has come
        for batch in slices(batches, "text"):
            columns = {c: batch.column(c).to_pylist() for c in ("_part", "_guest", "doc_id", "text")}
            own = sketches(batch.column("text"), k)
            pairs = []
            for part, guest, number, value, sketch in zip(*columns.values(), own):
                if guest and guest_of == part:
                    continue
                if held is not None and held[0] == part:
                    pairs.append((held, value, sketch))
                guest_of = part if guest else None
                held = None if guest else (part, number, value, sketch)
            if pairs:
                changed = [edited(row[2], following) for row, following, _ in pairs]
                after = []
                for piece in slices([pa.RecordBatch.from_arrays([pa.array(changed, pa.string())], ["text"])], "text"):
                    after += sketches(piece.column("text"), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row[1] for row, _, _ in pairs], pa.int64()),
                        pa.array([len(row[2]) for row, _, _ in pairs], pa.int64()),
                        pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]),
                        pa.array([encode(row[3]) for row, _, _ in pairs]),
                        pa.array([encode(s) for s in after]),
                        pa.array([resemblance(row[3], s, k) for (row, _, _), s in zip(pairs, after)]),
                        pa.array([resemblance(row[3], s, k) for row, _, s in pairs]),
                    ],
                    RESULT.names,
                )

    return bounded_batches(ordered).mapInArrow(run, RESULT)
