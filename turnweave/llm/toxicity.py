"""Toxicity from bags of subwords.

A word is the mean of the vectors of its character n-grams and of itself, a bag of words the mean
of its words, and a linear softmax over that mean gives the bag's class. Vectors and softmax are
trained together. The bag of a document is its worst words, one in ``ONE_IN`` of its distinct
ones, found among all of them; so the many harmless words of a text do not hide the others.

Training sees labels of documents only. Rounds of it alternate with the choice of each document's
bag under the model so far; the first choice is by the n-grams that toxic documents have more often.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches, by_place, with_arrow_columns
from turnweave.llm.words import ALPHANUMERIC, Words, mix, slices, words_of
from turnweave.session import local_table, materialize

#: Labelled documents of each class that training may see, at most; those of the least hashes.
SAMPLE_PER_CLASS = 1500
#: Bytes of text that training may see, half of them for either class.
SAMPLE_BYTES = 32 << 20
FOLDS, HELD_OUT = 5, 0
ONE_IN, LEAST = 50, 2
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
#: Words and texts looked at together, so that training needs little memory besides its sample.
WORD_BLOCK, TEXT_BLOCK = 20_000, 64
DIMENSIONS = 12
ROUNDS, EPOCHS, BATCH, RATE = 4, 2, 512, 0.3

ADDED = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def held_out(doc_id: Column) -> Column:
    """Whether a document is in the fold that is kept from training. A null id counts as an empty one, which is."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


@dataclass
class Bags:
    """Distinct words as lists of n-gram rows, and texts as numbers of distinct words."""

    rows: np.ndarray
    first: np.ndarray
    numbers: np.ndarray
    texts: np.ndarray

    def word_sums(self, values: np.ndarray) -> np.ndarray:
        """Mean of ``values`` over each word's rows."""
        sums = np.zeros(len(self.rows) + 1)
        np.cumsum(values[self.rows], out=sums[1:])
        return (sums[self.first[1:]] - sums[self.first[:-1]]) / np.maximum(np.diff(self.first), 1)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Texts and the numbers of their distinct words, in order."""
        size = len(self.first) - 1
        owner = np.repeat(np.arange(len(self.texts) - 1), np.diff(self.texts))
        key = np.unique(owner * size + self.numbers)
        return key // max(size, 1), key % max(size, 1)


def bags_of(texts: pa.Array) -> Bags:
    words = words_of(texts, ALPHANUMERIC)
    _, sample, numbers = np.unique(words.hashes, return_index=True, return_inverse=True)
    rows, first = gram_rows(words, sample)
    return Bags(rows, first, numbers, words.first)


def gram_rows(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the n-grams of some words, marked at both ends, and of the words themselves."""
    made, counts = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
    for at in range(0, len(chosen), WORD_BLOCK):
        some = chosen[at : at + WORD_BLOCK]
        letters = words_of_letters(lists_of_bytes(words, some))
        owners, hashes = [np.arange(len(some))], [letters.whole()]
        for n in GRAMS:
            places, found = letters.windows(n)
            owners.append(np.searchsorted(letters.first, places, side="right") - 1)
            hashes.append(found)
        owner, hashed = np.concatenate(owners), np.concatenate(hashes)
        made.append((hashed[np.argsort(owner, kind="stable")] % np.uint64(BUCKETS)).astype(np.int32))
        counts.append(np.bincount(owner, minlength=len(some)))
    return np.concatenate(made), np.cumsum(np.concatenate(counts))


def lists_of_bytes(words: Words, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen words' bytes in lower case between two marks, one after another, and their borders."""
    sizes = words.ends[chosen] - words.starts[chosen]
    borders = np.concatenate([[0], np.cumsum(sizes + 2)])
    out = np.empty(borders[-1], np.uint8)
    out[borders[:-1]], out[borders[1:] - 1] = ord("<"), ord(">")
    inner = np.repeat(borders[:-1] + 1, sizes) + (np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    outer = inner - np.repeat(borders[:-1] + 1, sizes) + np.repeat(words.starts[chosen], sizes)
    taken = words.data[outer]
    out[inner] = np.where((taken >= 0x41) & (taken <= 0x5A), taken + 32, taken)
    return out, borders


def words_of_letters(spelled: tuple[np.ndarray, np.ndarray]) -> Words:
    """Each word as a text whose words are its code points."""
    data, borders = spelled
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    ends = np.append(starts[1:], len(data))
    code = np.zeros(len(starts), np.uint64)
    for i in range(4):
        more = starts + i < ends
        code[more] = (code[more] << np.uint64(8)) | data[starts[more] + i]
    return Words(data, starts, ends, mix(code), np.searchsorted(starts, borders))


@dataclass
class Model:
    """What scoring needs of the trained vectors: each row's share in the logit."""

    logits: np.ndarray
    slope: float
    offset: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        bags = bags_of(texts)
        worst = worst_words(bags, bags.word_sums(self.logits))[0]
        logit = np.where(np.isfinite(worst), self.slope * worst + self.offset, -np.inf)
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50))) * np.isfinite(logit)


def worst_words(bags: Bags, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text the mean of its worst words; then those words' texts and numbers.

    A text without words has the lowest mean there is.
    """
    owner, number = bags.distinct()
    order = np.lexsort((-values[number], owner))
    owner, number = owner[order], number[order]
    counts = np.bincount(owner, minlength=len(bags.texts) - 1)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    taken = rank < np.maximum(LEAST, -(-counts // ONE_IN))[owner]
    owner, number = owner[taken], number[taken]
    sizes = np.bincount(owner, minlength=len(counts))
    sums = np.bincount(owner, values[number], minlength=len(counts))
    return np.where(sizes > 0, sums / np.maximum(sizes, 1), -np.inf), owner, number


def train(texts: pa.Array, toxic: np.ndarray, seed: int = 7) -> Model:
    """Fit vectors and softmax to labelled texts; a constant 0 if a class is missing."""
    bags = bags_of(texts)
    sizes = np.diff(bags.texts)
    toxic = toxic.astype(bool) & (sizes > 0)
    clean = ~toxic & (sizes > 0)
    if not toxic.any() or not clean.any():
        return Model(np.zeros(BUCKETS, np.float32), 0.0, -np.inf)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    output = random.uniform(-1, 1, (DIMENSIONS, 2)) / DIMENSIONS
    bias = np.zeros(2)
    squares = [np.full(BUCKETS, 1e-6), np.full(output.shape, 1e-6), np.full(2, 1e-6)]
    share = first_choice(bags, toxic, clean)
    lone = random.permutation(np.flatnonzero(clean[np.repeat(np.arange(len(sizes)), sizes)]))[: 4 * clean.sum()]
    examples = [(bags.numbers[lone], np.ones(len(lone), np.int64), np.zeros(len(lone), np.int64))]
    for _ in range(ROUNDS):
        _, owner, number = worst_words(bags, share)
        counts = np.bincount(owner, minlength=len(sizes))
        first = np.cumsum(counts) - counts
        whole = np.flatnonzero(counts)
        here = [*examples, (number, counts[whole], toxic[whole].astype(np.int64))]
        bag = np.concatenate([x for x, _, _ in here])
        width = np.concatenate([x for _, x, _ in here])
        target = np.concatenate([x for _, _, x in here])
        begin = np.cumsum(width) - width
        times = max(1, int((target == 0).sum() // max(1, 2 * (target == 1).sum())))
        chosen = np.concatenate([np.flatnonzero(target == 0), np.tile(np.flatnonzero(target == 1), times)])
        examples.append((np.concatenate([number[first[i] : first[i] + counts[i]] for i in np.flatnonzero(clean)]), counts[clean], np.zeros(clean.sum(), np.int64)))
        for _ in range(EPOCHS):
            order = random.permutation(chosen)
            for i in range(0, len(order), BATCH):
                some = order[i : i + BATCH]
                step(bags, bag, begin[some], width[some], target[some], vectors, output, bias, squares)
        logits = vectors @ (output[:, 1] - output[:, 0])
        share = bags.word_sums(logits)
    worst = worst_words(bags, share)[0]
    slope, offset = calibrate(worst[toxic], worst[clean])
    return Model(logits.astype(np.float32), slope, offset)


def first_choice(bags: Bags, toxic: np.ndarray, clean: np.ndarray) -> np.ndarray:
    """For each word, how much more often toxic texts have its most telling n-gram than clean ones."""
    owners, numbers = bags.distinct()
    found, clear = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for text in range(0, len(toxic), TEXT_BLOCK):
        low, high = np.searchsorted(owners, [text, text + TEXT_BLOCK])
        number = numbers[low:high]
        counts = np.diff(bags.first)[number]
        starts = np.repeat(bags.first[:-1][number] - (np.cumsum(counts) - counts), counts)
        rows = bags.rows[starts + np.arange(counts.sum())]
        key = np.unique(np.repeat(owners[low:high], counts) * BUCKETS + rows)
        owner, row = key // BUCKETS, key % BUCKETS
        found += np.bincount(row[toxic[owner]], minlength=BUCKETS)
        clear += np.bincount(row[clean[owner]], minlength=BUCKETS)
    expected = clear * (toxic.sum() / clean.sum())
    telling = (found - expected) / np.sqrt(found + expected + 1) * np.abs(np.log((found + 1) / (expected + 1)))
    out = np.full(len(bags.first) - 1, -np.inf)
    filled = np.flatnonzero(np.diff(bags.first))
    out[filled] = np.maximum.reduceat(telling[bags.rows], bags.first[:-1][filled])
    return out


def step(bags: Bags, bag: np.ndarray, begin: np.ndarray, width: np.ndarray, target: np.ndarray, vectors, output, bias, squares) -> None:
    """One gradient step with rates scaled by past gradients."""
    example = np.repeat(np.arange(len(target)), width)
    word = bag[np.repeat(begin - (np.cumsum(width) - width), width) + np.arange(width.sum())]
    counts = np.diff(bags.first)[word]
    at = np.repeat(bags.first[:-1][word] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
    rows, inverse = np.unique(bags.rows[at], return_inverse=True)
    weight = np.repeat(1.0 / (counts * width[example]), counts)
    example_of = np.repeat(example, counts)
    local = vectors[rows]
    mean = np.stack([np.bincount(example_of, weight * local[inverse, d], len(target)) for d in range(DIMENSIONS)], axis=1)
    logits = mean @ output + bias
    logits -= logits.max(axis=1, keepdims=True)
    error = np.exp(logits)
    error /= error.sum(axis=1, keepdims=True)
    error[np.arange(len(target)), target] -= 1
    back = error @ output.T
    gradient = np.stack([np.bincount(inverse, weight * back[example_of, d], len(rows)) for d in range(DIMENSIONS)], axis=1)
    squares[0][rows] += (gradient**2).mean(axis=1)
    vectors[rows] -= RATE * gradient / np.sqrt(squares[0][rows])[:, None]
    for value, slope, square in ((output, mean.T @ error / len(target), squares[1]), (bias, error.mean(axis=0), squares[2])):
        square += slope**2
        value -= 0.1 * slope / np.sqrt(square)


def calibrate(toxic: np.ndarray, clean: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """Slope and offset of a logistic curve over the texts' logits, both classes weighing the same."""
    x = np.concatenate([toxic, clean])
    centre, scale = x.mean(), x.std() + 1e-9
    x = (x - centre) / scale
    y = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    w = np.concatenate([np.full(len(toxic), 0.5 / len(toxic)), np.full(len(clean), 0.5 / len(clean))])
    slope, offset = 1.0, 0.0
    for _ in range(steps):
        error = w * (1 / (1 + np.exp(-(slope * x + offset))) - y)
        slope, offset = slope - 2 * ((error * x).sum() + 1e-3 * slope), offset - 2 * error.sum()
    return slope / scale, offset - slope * centre / scale


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS,
    sample_bytes: int = SAMPLE_BYTES,
) -> DataFrame:
    """Rows ``(text, label)`` of distinct texts, at most ``per_class`` documents and texts and half of
    ``sample_bytes`` of each class.

    Taken are the ids of the least hashes outside the held-out fold, whatever the table's order.
    Rows with a null id or label are left out; of contradicting labels the higher one counts.
    Where ids are repeated with more texts than that, those of the least text hashes are taken.
    A text that does not fit in what is left of its class's bytes is passed over.
    """
    known = (
        labels.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("_label"))
        .where("_id IS NOT NULL AND _label IS NOT NULL")
        .where(~held_out(F.col("_id")))
        .groupBy("_id")
        .agg(F.max("_label").alias("_label"))
    )
    order = [F.xxhash64("_id"), F.col("_id")]
    chosen = known.where("_label > 0").orderBy(*order).limit(per_class).unionAll(known.where("_label <= 0").orderBy(*order).limit(per_class))
    texts = (
        docs.select(F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("text"))
        .where("text IS NOT NULL")
        .join(F.broadcast(chosen), "_id")
        .groupBy("text")
        .agg((F.max("_label") > 0).cast("int").alias("label"))
        .withColumns({"mark": F.xxhash64("text"), "size": F.octet_length("text")})
    )
    # Written, so that the documents are read once for both classes.
    texts = materialize(texts, "labelled-texts")
    taken = []
    for one in (1, 0):
        left = sample_bytes // 2
        for row in texts.where(F.col("label") == one).select("mark", "size").orderBy("mark").limit(per_class).toLocalIterator():
            if row.size <= left:
                left -= row.size
                taken.append({"mark": row.mark})
    marks = local_table(docs.sparkSession, taken, T.StructType([T.StructField("mark", T.LongType())]))
    return texts.join(F.broadcast(marks), "mark", "left_semi").select("text", "label")


def give_back() -> None:
    """Return freed memory to the system, as a worker lives on after its task; where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", **bounds: int) -> Model:
    """The model of a sample of the labelled texts, whose ``bounds`` are those of ``labelled_sample``.

    One task trains on the sample; only the model, one number per n-gram row, comes to the driver.
    """

    def learn(batches):
        texts, labels = [pa.array([], pa.string())], [np.zeros(0, np.int64)]
        for batch in batches:
            texts.append(batch.column("text"))
            labels.append(batch.column("label").to_numpy())
        model = train(pa.chunked_array(texts).combine_chunks(), np.concatenate(labels) > 0)
        made = ([model.logits.astype(np.float32).tobytes()], [model.slope], [model.offset])
        del texts, labels, model
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(made, (pa.binary(), pa.float64(), pa.float64()))], ["logits", "slope", "offset"])

    sample = labelled_sample(docs, labels, doc_id, text, label, **bounds)
    row = bounded_batches(sample).repartition(1).sortWithinPartitions("text").mapInArrow(learn, "logits binary, slope double, offset double").first()
    if row is None:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, -np.inf)
    return Model(np.frombuffer(row.logits, np.float32), row.slope, row.offset)


def score_toxicity(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``score``, from 0 to 1, and ``predicted``, 1 from a score of 0.5 on.

    Only the text is looked at, all of it. Null texts and texts without words score 0. Columns
    of the same names are replaced.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers

    def make(batches):
        for batch in slices(batches, text):
            scores = sent.value.scores(batch.column(text))
            yield batch, {"score": pa.array(scores, pa.float64()), "predicted": pa.array((scores >= 0.5).astype(np.int32), pa.int32())}

    return with_arrow_columns(docs, text, ADDED, make)


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", **bounds: int) -> DataFrame:
    """The documents that are not predicted to be toxic, with the columns they came with."""
    placed = by_place(docs)
    scored = score_toxicity(placed, fit(docs, labels, doc_id, text, **bounds), f"c{docs.columns.index(text)}")
    return scored.where("predicted = 0").select(*placed.columns).toDF(*docs.columns)
