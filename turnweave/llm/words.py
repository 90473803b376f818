"""Words and word windows of Arrow text columns as 64-bit hashes, without a Python object per word.

A word's hash is a polynomial over its bytes, a window's one over its words' hashes; both
come from running sums, so a window of any length costs the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
BLOCK_BYTES = 1 << 19

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _table(lower: bool) -> np.ndarray:
    """One value per byte; the letters A to Z share those of a to z if ``lower``."""
    codes = np.arange(256, dtype=_U)
    if lower:
        codes[ord("A") : ord("Z") + 1] += _U(32)
    return mix((codes + _U(1)) * _U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), BLOCK_BYTES)
            self.up, self.down = (self._row(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _row(base: int, size: int) -> np.ndarray:
        row = np.full(size, base, _U)
        row[0] = 1
        return np.cumprod(row)


_BYTES = Powers(0xD6E8FEB86659FD93)
_WORDS = Powers(0xA0761D6478BD642F)


@dataclass(frozen=True)
class Kind:
    """Which bytes belong to words, and whether A to Z count as a to z."""

    member: np.ndarray
    table: np.ndarray


def _alphanumeric() -> np.ndarray:
    member = np.zeros(256, bool)
    for first, last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
        member[first : last + 1] = True
    return member


def _visible() -> np.ndarray:
    member = np.ones(256, bool)
    member[[0x20, *range(0x09, 0x0E)]] = False
    return member


#: Runs of digits, letters and characters beyond ASCII, A-Z lower-cased.
ALPHANUMERIC = Kind(_alphanumeric(), _table(lower=True))
#: Runs of anything but white space, unchanged.
EXACT = Kind(_visible(), _table(lower=False))
#: Runs of anything but white space, A-Z lower-cased.
FOLDED = Kind(_visible(), _table(lower=True))


@dataclass
class Words:
    """The words of some texts in order. ``first`` has len(texts) + 1 places into the words."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where ``n`` words of one text begin, and the hashes of those words."""
        total = len(self.hashes)
        if total < n:
            return np.zeros(0, np.int64), np.zeros(0, _U)
        counts = np.maximum(self.counts - (n - 1), 0)
        skipped = np.cumsum(counts) - counts
        places = np.arange(counts.sum()) + np.repeat(self.first[:-1] - skipped, counts)
        return places, self.hashes_at(places, n)

    def hashes_at(self, places: np.ndarray, n: int) -> np.ndarray:
        """Hashes of the ``n`` words from each place on."""
        sums, (_, down) = self.sums(), _WORDS.to(len(self.hashes) + 1)
        return mix((sums[places + n] - sums[places]) * down[places] + _U(n))

    def sums(self) -> np.ndarray:
        if not hasattr(self, "_sums"):
            up, _ = _WORDS.to(max(len(self.hashes), 1))
            self._sums = np.zeros(len(self.hashes) + 1, _U)
            np.cumsum(self.hashes * up[: len(self.hashes)], out=self._sums[1:])
        return self._sums

    def whole(self) -> np.ndarray:
        """One hash for each text's whole word sequence."""
        sums, (_, down) = self.sums(), _WORDS.to(len(self.hashes) + 1)
        begin, end = self.first[:-1], self.first[1:]
        return mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(_U))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text starts and ends; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words_of(texts: pa.Array, kind: Kind) -> Words:
    data, offsets = flat(texts)
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = kind.member[data]
    change = inside[1:] != inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    joined = edge[inside[edge] & inside[edge + 1]]  # texts that meet within two words
    places = np.flatnonzero(change)
    starts, ends = places[::2], places[1::2]
    if len(joined):
        joined = np.unique(joined)
        starts = np.sort(np.concatenate([starts, joined]))
        ends = np.sort(np.concatenate([ends, joined]))
    first = np.searchsorted(starts, offsets)
    return Words(data, starts, ends, _hashes(data, starts, ends, kind.table), first)


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), _U)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + BLOCK_BYTES)))
        low, high = starts[at], ends[to - 1]
        up, down = _BYTES.to(int(high - low) + 1)
        sums = np.zeros(high - low + 1, _U)
        np.cumsum(table[data[low:high]] * up[:-1], out=sums[1:])
        begin, end = starts[at:to] - low, ends[at:to] - low
        out[at:to] = mix((sums[end] - sums[begin]) * down[begin])
        at = to
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows again, in pieces of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        whole = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            used = whole[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(whole, used + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def lists(values: list | np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from all its values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))
