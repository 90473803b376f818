"""Importance resampling of documents towards a target distribution.

Runs of words are hashed into buckets; a bucket's gain is the logarithm of how much more often the
target has it than the documents. A document's weight is the mean gain of its features, and Gumbel
noise that depends on its id only turns the highest scores into a draw without replacement.

Words go through Arrow's kernels: texts are lower-cased, split and flattened, words dictionary-encoded.
Runs are pairs of shifted dictionary indices, so only distinct runs of a slice are ever spelled and hashed.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches, by_place, with_arrow_columns
from turnweave.llm.words import flat, slices
from turnweave.operators.ids import dense_ids
from turnweave.session import materialize

BUCKETS = 10_000
LONGEST = 1
SEED = 2024
PERCENT, LEAST_WORDS = 10, 20
#: Everything that is not part of a word, once A-Z are a-z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that share a dictionary.
SLICE_BYTES = 2 << 20
#: The bucket under which documents that are long enough to be drawn are counted.
LONG_ENOUGH = -1

_COUNTS = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("n", T.LongType())])
_ADDED = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of some texts in order, and the number of each one's text."""
    # A copy that begins at its first text: the kernels misread parts of a larger array.
    data, offsets = flat(texts)
    whole = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(data))
    parts = pc.split_pattern_regex(pc.ascii_lower(whole), BETWEEN)
    words, owner = pc.list_flatten(parts), pc.list_parent_indices(parts).to_numpy(zero_copy_only=False)
    # A text that begins or ends between words has an empty part there.
    full = pc.greater(pc.binary_length(words), 0)
    return words.filter(full), owner[full.to_numpy(zero_copy_only=False)]


def features(texts: pa.Array, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of run, every run's text and bucket, in order of the runs."""
    words, owner = _words(texts)
    encoded = words.dictionary_encode()
    index, spelled = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
    code, names = index, spelled
    for n in range(1, longest + 1):
        if n > 1:
            whole = owner[: max(0, len(owner) - n + 1)] == owner[n - 1 :]
            # code has a place for every shorter run; those that have no next word in their text are left out.
            pairs = np.full(len(whole), -1, np.int64)
            pairs[whole] = code[: len(whole)][whole] * len(spelled) + index[n - 1 :][whole]
            distinct, code = np.unique(pairs, return_inverse=True)
            ahead = distinct >= 0
            first, last = (pa.array(x) for x in (distinct[ahead] // max(1, len(spelled)), distinct[ahead] % max(1, len(spelled))))
            names = pc.binary_join_element_wise(names.take(first), spelled.take(last), pa.scalar(" ", pa.large_string()))
            code = code - np.count_nonzero(~ahead)
            places = np.flatnonzero(whole)
        else:
            places = np.arange(len(index))
        hashed = np.fromiter((zlib.crc32(name) % buckets for name in names.cast(pa.large_binary()).to_pylist()), np.int64, len(names))
        yield owner[places], hashed[code[places]]


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS, least_words: int = LEAST_WORDS) -> DataFrame:
    """Rows ``(bucket, n)``: how often features fall into each bucket; under ``LONG_ENOUGH`` the number
    of texts with ``least_words`` words or more. A task sends one row per bucket that it met."""

    def count(batches):
        counts, long_enough = np.zeros(buckets, np.int64), 0
        for batch in slices(batches, text, SLICE_BYTES):
            for n, (owner, bucket) in enumerate(features(batch.column(text), longest, buckets)):
                counts += np.bincount(bucket, minlength=buckets)
                if n == 0:
                    long_enough += int((np.bincount(owner, minlength=batch.num_rows) >= least_words).sum())
        met = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(met, LONG_ENOUGH), pa.int32()), pa.array(np.append(counts[met], long_enough), pa.int64())], _COUNTS.names
        )

    return bounded_batches(docs).select(text).mapInArrow(count, _COUNTS).groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, from counts with one more in every bucket."""
    sizes = [float(sum(n for b, n in counts.items() if b >= 0) + buckets) for counts in (source, target)]
    return np.array(
        [math.floor(1000 * math.log((target.get(b, 0) + 1.0) * sizes[0] / ((source.get(b, 0) + 1.0) * sizes[1]))) for b in range(buckets)],
        np.int64,
    )


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, the same for an id wherever it is. A null id counts as an empty one."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def with_weights(docs: DataFrame, gains: np.ndarray, doc_id: str = "doc_id", text: str = "text", longest: int = LONGEST, seed: int = SEED) -> DataFrame:
    """Add ``n_words``, ``n_features``, ``weight`` and ``score``. Nothing is shuffled.

    A null text or one without words has no features and weight 0. Columns of the same names are
    replaced.
    """

    def make(batches):
        for batch in slices(batches, text, SLICE_BYTES):
            rows = batch.num_rows
            n_words, n_features, sums = (np.zeros(rows, np.int64) for _ in range(3))
            for n, (owner, bucket) in enumerate(features(batch.column(text), longest, len(gains))):
                counts = np.bincount(owner, minlength=rows)
                ends = np.cumsum(counts)
                running = np.concatenate([[0], np.cumsum(gains[bucket])])
                sums += running[ends] - running[ends - counts]
                n_features += counts
                if n == 0:
                    n_words += counts
            weight = sums // np.maximum(n_features, 1)
            yield batch, {name: pa.array(x, pa.int64()) for name, x in zip(_ADDED.names, (n_words, n_features, weight))}

    weighed = with_arrow_columns(docs, text, _ADDED, make)
    return weighed.withColumn("score", F.col("weight") + noise(F.col(f"`{doc_id}`"), seed))


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, doc_id: str = "doc_id", n_long: int | None = None) -> DataFrame:
    """Add ``rank``, from 1 in order of falling scores and rising ids, for the ``percent`` highest
    scores of the rows with ``least_words`` words; null for the others.

    ``scored`` is read twice and should be written. A histogram of the scores, which are whole
    numbers of a narrow range, tells the least score that may be drawn, and only rows from there on
    are sorted. Null ids come first; rows that agree in score and id are ranked in any order.
    """
    eligible = scored.where(F.col("n_words") >= least_words)
    counts = sorted(((r.score, r.n) for r in eligible.groupBy("score").agg(F.count(F.lit(1)).alias("n")).toLocalIterator()), reverse=True)
    wanted = percent * (sum(n for _, n in counts) if n_long is None else n_long) // 100
    seen, cut = 0, None
    for score, n in counts:
        if seen >= wanted:
            break
        cut, seen = score, seen + n
    unranked = F.lit(None).cast("bigint").alias("rank")
    if cut is None:
        return scored.select("*", unranked)
    placed = by_place(scored)
    at = {c: f"c{i}" for i, c in enumerate(scored.columns)}
    near = (F.col(at["n_words"]) >= least_words) & (F.col(at["score"]) >= cut)
    names = [*placed.columns, "rank"]
    keyed = placed.where(near).withColumn("_falling", -F.col(at["score"]))
    carry = tuple(c for c in placed.columns if c != at[doc_id])
    ranked = dense_ids(keyed, "_falling", at[doc_id], carry=carry).withColumn("rank", F.col("id") + 1)
    ranked = ranked.select(*placed.columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    rest = placed.where(~near).select("*", unranked)
    return ranked.select(*names).unionByName(rest).toDF(*scored.columns, "rank")


def resample(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Rows ``(doc_id, n_words, n_features, weight, score, rank)``, one per document; drawn ones have a rank.

    Features are all runs of 1 to ``longest`` words. Texts of both tables are read whole, null ones
    have no words. An empty target or empty documents leave all counts at their prior; empty documents
    give no rows. Repeated rows are documents of their own, with the noise of their id. Other columns
    are left out; ``with_weights`` keeps them.
    """
    source, wanted = ({r.bucket: r.n for r in bucket_counts(x, text, longest, buckets, least_words).collect()} for x in (docs, target))
    gains = gains_of(source, wanted, buckets)
    narrow = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    weighed = with_weights(narrow, gains, longest=longest, seed=seed).select("doc_id", *_ADDED.names, "score")
    return draw(materialize(weighed, "scores"), percent, least_words, n_long=source.get(LONG_ENOUGH, 0)).withColumnRenamed("doc_id", doc_id)
