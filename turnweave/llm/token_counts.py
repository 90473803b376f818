"""Exact histogram of encoded lengths, and what its suffix sums answer.

Documents are encoded once; from then on only one row per distinct length is left, of which there
are at most as many as the square root of twice the tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import with_arrow_columns
from turnweave.llm.words import slices

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary cuts a text before its merges (fixed value of the public GPT-2 tokenizer).
CUTS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Lengths summed up together before sums run over blocks.
BLOCK = 1024

_loaded: dict[str, object] = {}


def encoding(path: str):
    """The encoding of a rank file, kept by path in each worker."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}
        _loaded[path] = tiktoken.Encoding("ranks", pat_str=CUTS, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def with_token_counts(docs: DataFrame, text: str = "text", name: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add each text's number of tokens; 0 for null and empty texts."""

    def make(batches):
        encode = encoding(tokenizer).encode_ordinary
        for batch in slices(batches, text):
            counts = [len(encode(value)) if value else 0 for value in batch.column(text).to_pylist()]
            yield batch, {name: pa.array(counts, pa.int64())}

    return with_arrow_columns(docs, text, T.StructType([T.StructField(name, T.LongType())]), make)


def length_histogram(counts: DataFrame, name: str = "n_tokens") -> DataFrame:
    """Rows ``(n_tokens, docs)``, one per length that occurs."""
    return counts.groupBy(F.col(name).alias("n_tokens")).agg(F.count(F.lit(1)).alias("docs"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Each length with what suffix sums tell for a context limit of that many tokens.

    ``docs_at_least`` and ``tokens_at_least`` count documents of that length or more and their
    tokens; ``docs_up_to`` the others and those of just that length, which is their rank for
    quantiles; ``truncated_tokens`` what is left of all tokens if each document is cut there. Sums run within blocks
    of lengths, then over the blocks. An empty histogram gives no rows.
    """
    rows = histogram.select(
        "n_tokens", "docs", (F.col("n_tokens") * F.col("docs")).alias("tokens"), F.floor(F.col("n_tokens") / BLOCK).alias("block")
    )
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
    all_blocks = Window.partitionBy(F.lit(0))  # one row per BLOCK lengths
    later = all_blocks.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("docs").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("tokens").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("docs").over(all_blocks).alias("all_docs"),
        F.sum("tokens").over(all_blocks).alias("all_tokens"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    docs, tokens = F.col("docs_at_least"), F.col("tokens_at_least")
    return (
        rows.withColumns({"d": F.sum("docs").over(inside), "t": F.sum("tokens").over(inside)})
        .join(blocks, "block")
        .withColumns({"docs_at_least": F.col("d") + F.col("later_docs"), "tokens_at_least": F.col("t") + F.col("later_tokens")})
        .select(
            "n_tokens",
            "docs",
            "tokens",
            "docs_at_least",
            "tokens_at_least",
            (F.col("all_docs") - docs + F.col("docs")).alias("docs_up_to"),
            (F.col("all_tokens") - tokens + F.col("n_tokens") * docs).alias("truncated_tokens"),
            "all_docs",
            "all_tokens",
        )
    )


def at_limits(histogram: DataFrame, limits: Iterable[int]) -> DataFrame:
    """The suffix sums at the given context limits, whether or not a document has that length."""
    asked = histogram.sparkSession.createDataFrame([(int(n),) for n in sorted(set(limits))], "limit long")
    zero = asked.select(F.col("limit").alias("n_tokens"), F.lit(0).cast("bigint").alias("docs"))
    merged = histogram.select("n_tokens", "docs").unionByName(zero).groupBy("n_tokens").agg(F.sum("docs").alias("docs"))
    return suffix_sums(merged).join(F.broadcast(asked.withColumnRenamed("limit", "n_tokens")), "n_tokens")


def quantiles(sums: DataFrame, fractions: Iterable[float]) -> DataFrame:
    """Rows ``(fraction, n_tokens)``: the least length that covers the fraction of documents."""
    asked = sums.sparkSession.createDataFrame([(float(f),) for f in sorted(set(fractions))], "fraction double")
    covered = F.col("docs_up_to") >= F.col("fraction") * F.col("all_docs")
    return sums.join(F.broadcast(asked), covered).groupBy("fraction").agg(F.min("n_tokens").alias("n_tokens"))
