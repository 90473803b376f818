"""Preparation of training rows."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnweave.functions import tokens
from turnweave.session import materialize

HASHES = 1 << 32
HASH_BITS, ROUND_BITS = 60, 15


def stable_hash(key: Column) -> Column:
    """A number below 2**32 that depends on the key alone: the first 32 bits of its MD5."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint")


def with_split(df: DataFrame, key: str, val_set_size: float = 0.02) -> DataFrame:
    """Add ``split``. It depends on the key alone, not on partitioning or order."""
    held_out = stable_hash(F.col(key)) < F.lit(val_set_size * HASHES)
    return df.withColumn("split", F.when(held_out, "validation").otherwise("train"))


def long_hash(key: Column) -> Column:
    """A number below 2**60 that depends on the key alone: the first 60 bits of its MD5."""
    digits = F.substring(F.md5(key.cast("string").cast("binary")), 1, HASH_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint")


def kth_bound(hashes: DataFrame, name: str, k: int, bits: int = HASH_BITS) -> int:
    """The largest number with at most ``k`` of the column's values below it.

    Found by radix: each round counts the values of one prefix by their next ``ROUND_BITS`` bits and goes on in
    the bin of the next value after the ``k``-th. No row is sorted or moved; a round brings 2**ROUND_BITS
    counts to the driver.
    """
    low, left = 0, k
    while bits > 0:
        step = min(bits, ROUND_BITS)
        inside = hashes.where((F.col(name) >= low) & (F.col(name) < low + (1 << bits)))
        bits -= step
        place = F.shiftright(F.col(name) - F.lit(low), bits).alias("place")
        counts = {r.place: r.n for r in inside.groupBy(place).agg(F.count(F.lit(1)).alias("n")).collect()}
        at = 0
        for at in range(1 << step):
            if counts.get(at, 0) > left:
                break
            left -= counts.get(at, 0)
        else:
            return low + (1 << (bits + step))
        low += at << bits
    return low


def with_exact_split(df: DataFrame, key: str, val_set_size: float = 0.02) -> DataFrame:
    """Add ``split`` with exactly ``round(val_set_size * n)`` validation rows, halves rounded to even.

    They are those of the least key hashes, so a row's side depends on partitioning or order in no
    way. Rows of one key, a null key included, stay together: where keys are repeated, there may be fewer.
    """
    hashed = F.coalesce(long_hash(F.col(key)), F.lit(0))
    hashes = df.select(hashed.alias("hash"))
    bound = kth_bound(hashes, "hash", round(val_set_size * hashes.count()))
    return df.withColumn("split", F.when(hashed < F.lit(bound), "validation").otherwise("train"))


def with_length(
    df: DataFrame,
    text: str,
    sequence_len: int = 2048,
    count: tokens.Tokenizer = tokens.word_count,
) -> DataFrame:
    """Add the token count and whether it fits ``sequence_len``."""
    return df.withColumn("n_tokens", count(F.col(text))).withColumn(
        "fits", F.col("n_tokens") <= sequence_len
    )


def with_capped(df: DataFrame, tokens_column: str, limit: int) -> DataFrame:
    """Cut token arrays to ``limit`` and say where something was cut."""
    all_tokens = F.col(tokens_column)
    return df.withColumn("truncated", F.size(all_tokens) > limit).withColumn(
        tokens_column, tokens.cap_tokens(all_tokens, limit)
    )


def fan_out(df: DataFrame, num_generations: int = 4) -> DataFrame:
    """Each prompt once per generation, numbered from 0."""
    return df.withColumn("gen_idx", F.explode(F.sequence(F.lit(0), F.lit(num_generations - 1))))


class _Packer:
    """Next-fit over the rows of one shard after another, fed batch by batch."""

    def __init__(self, room: int):
        self.room = room
        self.shard = None
        self.pack = self.position = self.used = 0

    def place(self, shard, lengths: np.ndarray) -> np.ndarray:
        """Rows of ``(pack, pos, offset)`` for consecutive sequences of a shard."""
        if shard != self.shard:
            self.shard, self.pack, self.position, self.used = shard, 0, 0, 0
        ends = np.cumsum(lengths)
        placed = np.empty((len(lengths), 3), dtype=np.int64)
        start = 0
        while start < len(lengths):
            before = ends[start - 1] if start else 0
            stop = int(np.searchsorted(ends, before + self.room - self.used, side="right"))
            if stop <= start:
                if self.position:
                    self.pack, self.position, self.used = self.pack + 1, 0, 0
                    continue
                stop = start + 1  # longer than a pack: it gets one of its own
            rows = slice(start, stop)
            placed[rows, 0] = self.pack
            placed[rows, 1] = self.position + np.arange(stop - start)
            placed[rows, 2] = self.used + ends[rows] - lengths[rows] - before
            self.position += stop - start
            self.used += int(ends[stop - 1] - before)
            start = stop
        return placed


class _BestFit:
    """Best fit over the rows of one shard after another: each sequence goes to the fullest pack that takes
    it, of equal ones to the oldest. Open packs are kept in order of the room they have left."""

    def __init__(self, room: int):
        self.room = room
        self.shard = None
        self.packs = 0
        self.open: list[tuple[int, int, int]] = []  # room left, pack, sequences in it

    def place(self, shard, lengths: np.ndarray) -> np.ndarray:
        if shard != self.shard:
            self.shard, self.packs, self.open = shard, 0, []
        placed = np.empty((len(lengths), 3), dtype=np.int64)
        for row, length in enumerate(lengths.tolist()):
            at = bisect_left(self.open, (length, -1, 0))
            if at < len(self.open):
                left, pack, position = self.open.pop(at)
            else:
                left, pack, position = self.room, self.packs, 0
                self.packs += 1
            placed[row] = pack, position, self.room - left
            if left - length > 0:
                insort(self.open, (left - length, pack, position + 1))
        return placed


PACKERS = {"next": _Packer, "best": _BestFit}


def _pack_partition(
    frames: Iterator[pd.DataFrame], room: int, length: str, fit: str = "next"
) -> Iterator[pd.DataFrame]:
    packer = PACKERS[fit](room)
    for frame in frames:
        shards = frame["shard"].to_numpy()
        lengths = frame[length].to_numpy(dtype=np.int64)
        borders = np.flatnonzero(shards[1:] != shards[:-1]) + 1
        pieces = zip(np.split(shards, borders), np.split(lengths, borders))
        placed = [packer.place(s[0], n) for s, n in pieces if len(s)]
        if placed:
            pack, pos, offset = np.concatenate(placed).T
            yield frame.assign(pack=pack, pos=pos, offset=offset)


def pack_sequences(
    df: DataFrame, key: str, length: str = "n_tokens", sequence_len: int = 2048, shard_rows: int = 4096, fit: str = "next"
) -> DataFrame:
    """Put sequences into packs of ``sequence_len`` tokens: ``(shard, pack, pos, offset)``.

    Shards are by a hash of the key, which may be of any type that casts to a string, and about
    ``shard_rows`` rows each, however the keys are spread; they grow in number with the data,
    not in size. Sequences are taken in key order within a shard; a new pack starts when the next
    one does not fit. Each shard is packed as its rows stream by. The result depends on
    ``shard_rows``. A sequence longer than a pack gets its own, with ``fits`` false. The key has to
    tell rows apart: all rows of one key are in one shard.

    With ``fit="best"`` a shard's sequences are taken from the longest one on, and each goes to the
    fullest pack that has room for it. Only the room of the shard's open packs is kept, no sequence.
    """
    if fit not in PACKERS:
        raise ValueError(f"fit must be one of {sorted(PACKERS)}")
    # Written, so that lengths are counted once; the number of rows then comes from the files' ends.
    narrow = materialize(df.select(key, length), "sequence-lengths")
    shards = max(1, -(-narrow.count() // shard_rows))
    sharded = narrow.withColumn("shard", stable_hash(F.col(key)) % shards)
    order = ["shard", key] if fit == "next" else ["shard", F.desc(length), key]
    ordered = sharded.repartition("shard").sortWithinPartitions(*order)
    kinds = dict(ordered.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in ordered.columns)
    packed = ordered.mapInPandas(
        partial(_pack_partition, room=sequence_len, length=length, fit=fit),
        f"{schema}, pack bigint, pos bigint, offset bigint",
    )
    return packed.withColumn("fits", F.col(length) <= sequence_len)


def pack_padding(packed: DataFrame, length: str = "n_tokens", sequence_len: int = 2048) -> DataFrame:
    """Padding and fill of each pack that fits."""
    used = F.sum(length)
    return (
        packed.where("fits")
        .groupBy("shard", "pack")
        .agg(
            F.count(F.lit(1)).alias("n_sequences"),
            used.alias("used"),
            (F.lit(sequence_len) - used).alias("pad"),
        )
        .withColumn("fill", F.col("used") / F.lit(float(sequence_len)))
    )
