"""Benchmark decontamination with a suffix automaton of the test items.

The items' words are compiled into one generalised suffix automaton. Each document's words are
streamed through it; the longest match that ends at a word is tracked, and where it reaches a
window's length, the window's words are hit and the items that hold it are known from the state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches, by_place, with_arrow_columns
from turnweave.llm.words import ALPHANUMERIC, Words, flat, lists, slices, words_of
from turnweave.session import materialize

WINDOW = 13
#: A document is contaminated when ``MIN_SHARE`` times its hit words reach all its words.
MIN_SHARE = 20
#: Item words compiled into one automaton; more items take further passes over the documents.
BLOCK_WORDS = 100_000

ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("longest", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("spans", T.ArrayType(T.LongType())),
    ]
)


class Automaton:
    """A generalised suffix automaton over word numbers, with the items of each window."""

    def __init__(self, window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.items: dict[int, set[str]] = {}
        self.window_state: list[int] = []
        self.short_state: list[int] = []

    def _state(self, length: int, link: int, out: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(out)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The state of exactly the strings one word longer than ``state``."""
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            known = self.next[last].get(word)
            if known is not None:
                fits = self.length[known] == self.length[last] + 1
                last = known if fits else self._split(last, word, known)
                continue
            state, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.next[at]:
                self.next[at][word] = state
                at = self.link[at]
            if at >= 0:
                known = self.next[at][word]
                fits = self.length[known] == self.length[at] + 1
                self.link[state] = known if fits else self._split(at, word, known)
            last = state

    def finish(self, items: list[tuple[str | None, list[int]]]) -> None:
        """Find for each state the one of its last ``window`` words, and the nearest short item."""
        order = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.window_state = [-1] * len(order)
        for state in order[1:]:
            if self.length[state] >= self.window:
                above = self.link[state]
                self.window_state[state] = state if self.length[above] < self.window else self.window_state[above]
        shorts: set[int] = set()
        for item, words in items:
            if not words:
                continue
            if len(words) < self.window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                shorts.add(state)
                self.items.setdefault(state, set()).update([item] if item is not None else [])
                continue
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= self.window:
                    self.items.setdefault(self.window_state[state], set()).update([item] if item is not None else [])
        self.short_state = [-1] * len(order)
        for state in order[1:]:
            above = self.link[state]
            self.short_state[state] = state if state in shorts else self.short_state[above]

    def hits(self, words: list[int]) -> Iterator[tuple[int, int, int]]:
        """``(end, hit length, state of the items)`` and, with state -1, ``(end, longest match, -1)``."""
        step, link, length, window = self.next, self.link, self.length, self.window
        state = matched = 0
        for i, word in enumerate(words):
            after = step[state].get(word)
            while after is None and state:
                state = link[state]
                matched = length[state]
                after = step[state].get(word)
            if after is None:
                continue
            state, matched = after, matched + 1
            yield i + 1, matched, -1
            if matched >= window:
                yield i + 1, window, self.window_state[state]
            short = self.short_state[state]
            if short == state and matched < length[state]:
                short = self.short_state[link[state]]
            while short > 0:
                yield i + 1, length[short], short
                short = self.short_state[link[short]]


class Matcher:
    """The automaton of some items, ready to be sent to tasks."""

    def __init__(self, items: list[tuple[str | None, np.ndarray]], window: int):
        self.vocabulary = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
        numbered = [(item, np.searchsorted(self.vocabulary, h).tolist()) for item, h in items]
        self.automaton = Automaton(window)
        for _, words in numbered:
            self.automaton.add(words)
        self.automaton.finish(numbered)
        self.shortest = min((min(len(words), window) for _, words in numbered if words), default=window)

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers, -1 for words that no item has."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)

    def match(self, numbers: np.ndarray) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans, items and the longest match of one document.

        A word of no item ends every match, so only runs of item words are streamed.
        """
        known = np.concatenate([[False], numbers >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        longest = 0
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin < self.shortest:
                continue
            for to, size, state in self.automaton.hits(numbers[begin:end].tolist()):
                if state < 0:
                    longest = max(longest, size)
                    continue
                spans.append((begin + to - size, begin + to))
                items |= self.automaton.items[state]
        return merge(spans), items, longest


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans in order without overlap."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out


def _blocks(items: DataFrame, item_id: str, text: str, window: int, limit: int) -> Iterator[list]:
    """Item words in blocks; an item beyond a block is cut into pieces that share windows."""
    block, size = [], 0
    for row in items.select(F.col(item_id).cast("string").alias("i"), F.col(text).alias("t")).toLocalIterator():
        hashes = words_of(pa.array([row.t], pa.string()), ALPHANUMERIC).hashes
        at = 0
        while len(hashes):
            piece = hashes[at : at + limit]
            if block and size + len(piece) > limit:
                yield block
                block, size = [], 0
            block.append((row.i, piece))
            size += len(piece)
            at += max(limit - window + 1, 1)
            if at + window - 1 >= len(hashes) or len(hashes) <= limit:
                break
    if block:
        yield block


def contamination(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Each document with ``n_words``, ``n_hit``, ``longest``, ``item_ids`` and ``spans``.

    A window is ``window`` consecutive words of an item, or the whole of a shorter one. A word
    within any occurrence of a window is hit; ``spans`` lists begin and end of runs of hit words in
    turn. ``longest`` is the longest match of a document with any item, in words, 0 where all
    runs of item words are shorter than every window.

    Null and empty texts have no words and no hits. Items without words have no window; an item
    without an id marks words but is not listed; repeated items count once. Columns of the
    documents that bear an added name are replaced. Rows are not moved: items are sent to the
    tasks, at most ``block_words`` words at a time. Where there are more, texts are written once and each
    block of items reads them, leaving only what it finds.
    """
    out = _matched(docs, items, text, item_id, item_text, window, block_words)
    return out.select(*[F.col(f"`{c}`") for c in out.columns if c not in ADDED.names], *ADDED.names)


def _matched(
    docs: DataFrame, items: DataFrame, text: str, item_id: str, item_text: str, window: int, block_words: int, min_share: int | None = None
) -> DataFrame:
    """The documents with what the items hit; with ``min_share`` also the text that is left of
    contaminated documents as ``_cut``."""
    spark = docs.sparkSession
    blocks = _enough(_blocks(items, item_id, item_text, window, max(block_words, window)))
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return _pass(docs, spark.sparkContext.broadcast(Matcher(block, window)), text, min_share)
    # More blocks than one: texts are written once, with a number for each row, and blocks leave what they find.
    placed = by_place(docs)
    place = f"c{docs.columns.index(text)}"
    numbered = materialize(placed.withColumn("row", F.monotonically_increasing_id()), "numbered-documents")
    found = None
    while block is not None:
        # Only this block and the next one are on the driver.
        sent = spark.sparkContext.broadcast(Matcher(block, window))
        here = materialize(_hits(numbered.select("row", place), sent, place), "block-hits")
        sent.unpersist()
        found = here if found is None else found.unionByName(here)
        block, following = following, next(blocks, None)
    # At most one row per block and document.
    gathered = found.groupBy("row").agg(F.collect_list(F.struct("spans", "item_ids", "longest")).alias("found"))
    whole = _gathered(numbered.join(gathered, "row", "left").drop("row"), place, min_share)
    kept = [c for c in docs.columns if c not in ADDED.names or c == text]
    made = [c for c in whole.columns if c not in placed.columns]
    return whole.select(*[F.col(f"c{docs.columns.index(c)}").alias(c) for c in kept], *made)


def _enough(blocks: Iterator[list]) -> Iterator[list]:
    """The blocks, or an empty one if there is none."""
    count = 0
    for block in blocks:
        count += 1
        yield block
    if not count:
        yield []


def without_spans(words: Words, first: int, begin: int, end: int, spans: list[tuple[int, int]]) -> str:
    """A text's bytes from ``begin`` to ``end`` without spans of its words, which start at ``first``."""
    kept = []
    for a, b in spans:
        kept.append(words.data[begin : words.starts[first + a]].tobytes())
        begin = int(words.ends[first + b - 1])
    return b"".join([*kept, words.data[begin:end].tobytes()]).decode()


HITS = T.StructType([T.StructField("row", T.LongType()), *(f for f in ADDED if f.name in ("spans", "item_ids", "longest"))])


def _hits(rows: DataFrame, matcher, text: str) -> DataFrame:
    """What a block of items finds: spans, items and longest match of the rows in which it finds anything."""

    def make(batches):
        for batch in slices(batches, text):
            words = words_of(batch.column(text), ALPHANUMERIC)
            numbers = matcher.value.numbers(words.hashes)
            matched = [matcher.value.match(numbers[a:b]) for a, b in zip(words.first[:-1], words.first[1:])]
            met = [i for i, (_, _, longest) in enumerate(matched) if longest]
            columns = {
                "row": batch.column("row").take(pa.array(met, pa.int64())),
                "spans": lists([p for i in met for x in matched[i][0] for p in x], [2 * len(matched[i][0]) for i in met], pa.int64()),
                "item_ids": lists([x for i in met for x in sorted(matched[i][1])], [len(matched[i][1]) for i in met], pa.string()),
                "longest": pa.array([matched[i][2] for i in met], pa.int64()),
            }
            yield pa.RecordBatch.from_arrays([columns[c] for c in HITS.names], HITS.names)

    return bounded_batches(rows).mapInArrow(make, HITS)


def _columns(batch: pa.RecordBatch, text: str, words: Words, found: list, min_share: int | None) -> dict[str, pa.Array]:
    """The added columns of some rows from the spans, items and longest match of each."""
    hit = [sum(e - b for b, e in spans) for spans, _, _ in found]
    made = {
        "n_words": pa.array(words.counts, pa.int64()),
        "n_hit": pa.array(hit, pa.int64()),
        "longest": pa.array([n for _, _, n in found], pa.int64()),
        "item_ids": lists([i for _, x, _ in found for i in x], [len(x) for _, x, _ in found], pa.string()),
        "spans": lists([p for s, _, _ in found for x in s for p in x], [2 * len(s) for s, _, _ in found], pa.int64()),
    }
    if min_share is not None:
        offsets = flat(batch.column(text))[1]
        cut: list[str | None] = []
        for row, (spans, _, _) in enumerate(found):
            goes = hit[row] and hit[row] * min_share >= int(words.counts[row])
            cut.append(without_spans(words, int(words.first[row]), int(offsets[row]), int(offsets[row + 1]), spans) if goes else None)
        made["_cut"] = pa.array(cut, pa.string())
    return made


def _added(min_share: int | None) -> T.StructType:
    return ADDED if min_share is None else T.StructType([*ADDED, T.StructField("_cut", T.StringType())])


def _pass(docs: DataFrame, matcher, text: str, min_share: int | None) -> DataFrame:
    """The only pass where one block holds all items."""

    def make(batches):
        for batch in slices(batches, text):
            words = words_of(batch.column(text), ALPHANUMERIC)
            numbers = matcher.value.numbers(words.hashes)
            found = []
            for a, b in zip(words.first[:-1], words.first[1:]):
                spans, items, longest = matcher.value.match(numbers[a:b])
                found.append((spans, sorted(items), longest))
            yield batch, _columns(batch, text, words, found, min_share)

    return with_arrow_columns(docs, text, _added(min_share), make)


def _gathered(docs: DataFrame, text: str, min_share: int | None) -> DataFrame:
    """The added columns from what the blocks have found, in ``found``."""

    def make(batches):
        for batch in slices(batches, text):
            words = words_of(batch.column(text), ALPHANUMERIC)
            found = []
            for parts in batch.column("found").to_pylist():
                parts = parts or []
                spans = merge([x for part in parts for x in zip(part["spans"][::2], part["spans"][1::2])])
                items = sorted({i for part in parts for i in part["item_ids"]})
                found.append((spans, items, max((part["longest"] for part in parts), default=0)))
            yield batch, _columns(batch, text, words, found, min_share)

    return with_arrow_columns(docs, text, _added(min_share), make).drop("found")


def is_contaminated(min_share: int = MIN_SHARE):
    return (F.col("n_hit") > 0) & (F.col("n_hit") * min_share >= F.col("n_words"))


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    min_share: int = MIN_SHARE,
) -> DataFrame:
    """The documents without the spans that exceed the limits; columns stay as they are.

    From a document whose hit words reach one in ``min_share`` of its words, every span of hit words
    goes, with what stands between the span's words. One of which no word is left goes itself.
    Other documents, among them null and empty texts, stay unchanged.
    """
    placed = by_place(docs)
    place = f"c{docs.columns.index(text)}"
    marked = _matched(placed, items, place, item_id, item_text, window, block_words, min_share)
    left = marked.where(~(is_contaminated(min_share) & (F.col("n_hit") == F.col("n_words"))))
    value = F.when(is_contaminated(min_share), F.col("_cut")).otherwise(F.col(place))
    return left.withColumn(place, value).select(*placed.columns).toDF(*docs.columns)


def items_digest():
    """Hex SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.array_join(F.sort_array("item_ids"), ",").cast("binary"), 256)
