"""Removal of passages that occur more than once, found by level-wise doubling.

Windows of a quarter of the length come first, then of half of it, then of all of it. Only where a
window's shorter one is repeated is the longer one looked at, until the full length is reached or no
candidate is left. On the first level the window of the least hash among those within a full one
stands for them: equal full windows have the same one, and few words have to be looked at.

Documents are written once, packed in chunks, to a table bucketed by chunk. Each level sends every
distinct hash of a chunk once, by ranges of hashes, and gets one bit for each back: a passage in a
third of all documents is one hash per chunk, and texts never move again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches
from turnweave.llm.words import EXACT, Words, lists, slices, words_of
from turnweave.session import materialize, shared_folder

WINDOW = 35
CHUNK_BYTES = 4 << 20
#: Hashes compared in one task, and bytes of text in one bucket of the table, about.
BUCKET_HASHES = 4_000_000
BUCKET_BYTES = 64 << 20
#: The most buckets a table may have.
MAX_BUCKETS = 100_000

CHUNKS = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("texts", T.ArrayType(T.StringType())),
    ]
)
SENT = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("chunk", T.LongType()), T.StructField("hashes", T.BinaryType()), T.StructField("several", T.BinaryType())])
ANSWER = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("bucket", T.IntegerType()), T.StructField("bits", T.BinaryType())])
RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())])


def levels_of(window: int) -> list[int]:
    """Lengths that double up to the window's."""
    return sorted({-(-window // 4), -(-window // 2), window})


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbouring values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


@dataclass
class Level:
    """The candidates of a chunk on one level: places of full windows, each with a number of a
    distinct hash, and those hashes in the order in which they are sent."""

    places: np.ndarray
    number: np.ndarray
    hashes: np.ndarray
    buckets: np.ndarray
    several: np.ndarray


def _level(places: np.ndarray, values: np.ndarray, among: np.ndarray, buckets: int) -> Level:
    """``among``: the values of all places, by which a value occurs several times in the chunk."""
    distinct, number = np.unique(values, return_inverse=True)
    bucket = ((distinct >> np.uint64(20)) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    distinct = distinct[order]
    if among is values:
        counts = np.bincount(number, minlength=len(order))[order]
    else:
        where = np.minimum(np.searchsorted(distinct[rank], among), max(len(order) - 1, 0))
        hit = distinct[rank][where] == among if len(order) else np.zeros(0, bool)
        counts = np.bincount(where[hit], minlength=len(order))[order]
    return Level(places, rank[number], distinct, bucket[order], counts > 1)


def candidates(words: Words, window: int, answers: list[np.ndarray], buckets: int) -> Level | np.ndarray:
    """The next level's candidates after the levels that are answered; after the last the places of
    repeated windows."""
    lengths = levels_of(window)
    places, _ = words.windows(window)
    level = None
    for number in range(len(answers) + 1):
        if number:
            places = level.places[answers[number - 1][level.number]]
            if number == len(lengths):
                return places
        if number or len(lengths) == 1:
            values = words.hashes_at(places, lengths[number])
            level = _level(places, values, values, buckets)
        else:
            at, short = words.windows(lengths[0])
            width = window - lengths[0] + 1
            least = lowest(short, width)[np.searchsorted(at, places)] if len(places) else short[:0]
            level = _level(places, least, short, buckets)
    return level


def _chunked(docs: DataFrame) -> DataFrame:
    """Documents packed into rows of about ``CHUNK_BYTES``, numbered by task and turn."""

    def pack(batches):
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0
        for piece in slices(batches, "_text", CHUNK_BYTES // 4):
            held.append(piece)
            size += piece.column("_text").nbytes
            if size >= CHUNK_BYTES:
                yield row(held, number)
                held, size, number = [], 0, number + 1
        if held:
            yield row(held, number)

    def row(held, number):
        table = pa.Table.from_batches(held).combine_chunks()
        columns = [table.column(c).combine_chunks() for c in ("_id", "_text")]
        columns[1] = columns[1].fill_null("")
        count = [table.num_rows]
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), lists(columns[0], count, pa.int64()), lists(columns[1], count, pa.string())], CHUNKS.names
        )

    return bounded_batches(docs).mapInArrow(pack, CHUNKS)


def _stored(chunks: DataFrame, buckets: int) -> DataFrame:
    """The chunks as a table bucketed by chunk in the shared folder."""
    spark = chunks.sparkSession
    name = f"chunks_{uuid.uuid4().hex}"
    path = shared_folder(spark, name)
    chunks.write.bucketBy(buckets, "chunk").option("path", path).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _unpacked(batch: pa.RecordBatch, window: int, levels: int, buckets: int):
    """Each chunk of a batch with its ids, texts, words and next candidates."""
    for at in range(batch.num_rows):
        ids, texts = (batch.column(c)[at].values for c in ("ids", "texts"))
        words = words_of(texts, EXACT)
        answers = []
        for number in range(levels):
            column = batch.column(f"answer_{number}")[at].as_py() or []
            parts = [np.unpackbits(np.frombuffer(x["bits"], np.uint8)[4:])[: int.from_bytes(x["bits"][:4], "little")] for x in sorted(column, key=lambda x: x["bucket"])]
            answers.append(np.concatenate([np.zeros(0, np.uint8), *parts]).astype(bool))
        yield batch.column("chunk")[at].as_py(), ids, texts, words, candidates(words, window, answers, buckets)


def _ask(table: DataFrame, window: int, level: int, buckets: int) -> DataFrame:
    """Which distinct hashes of a level occur elsewhere as well: rows ``(chunk, answer)``."""

    def send(batches):
        for batch in batches:
            for chunk, _, _, _, found in _unpacked(batch, window, level, buckets):
                edges = np.searchsorted(found.buckets, np.arange(buckets + 1))
                filled = np.flatnonzero(np.diff(edges)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(filled, pa.int32()),
                        pa.array([chunk] * len(filled), pa.int64()),
                        pa.array([found.hashes[edges[b] : edges[b + 1]].tobytes() for b in filled], pa.binary()),
                        pa.array([np.packbits(found.several[edges[b] : edges[b + 1]]).tobytes() for b in filled], pa.binary()),
                    ],
                    SENT.names,
                )

    def compare(rows: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows.column("hashes")]
        several = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8))[: len(h)] for x, h in zip(rows.column("several"), hashes)]
        whole = np.concatenate(hashes)
        order = np.argsort(whole, kind="stable")
        ordered = whole[order]
        same = np.concatenate([[False], ordered[1:] == ordered[:-1], [False]])
        alive = np.empty(len(whole), bool)
        alive[order] = same[1:] | same[:-1]
        alive |= np.concatenate(several).astype(bool)
        edges = np.cumsum([0, *map(len, hashes)])
        bits = [len(h).to_bytes(4, "little") + np.packbits(alive[a:b]).tobytes() for h, a, b in zip(hashes, edges[:-1], edges[1:])]
        return pa.table([rows.column("chunk"), rows.column("bucket"), pa.array(bits, pa.binary())], names=ANSWER.names)

    answers = table.mapInArrow(send, SENT).groupBy("bucket").applyInArrow(compare, ANSWER)
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"answer_{level}"))


def _any_alive(answers: DataFrame, level: int) -> bool:
    bits = F.explode(f"answer_{level}.bits").alias("bits")
    return not answers.select(bits).where(F.hex(F.substring("bits", 5, 1 << 30)).rlike("[^0]")).isEmpty()


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Rows ``(doc_id, n_words, n_removed, kept)``, one per document.

    Words are separated by white space. Each word goes that a window of ``window`` words covers whose
    words also start somewhere else, in the same document or another; windows are those of the input.
    ``kept`` joins what is left by one space. Texts of fewer words keep all; null and empty
    texts have no words and an empty ``kept``. Repeated rows repeat each other's windows. An empty table
    gives no rows. Windows are told apart by 64-bit hashes on every level.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), F.col(f"`{text}`").alias("_text"))
    size = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(tasks, -(-size // (6 * BUCKET_HASHES)))
    table = _stored(_chunked(rows), min(MAX_BUCKETS, max(tasks, -(-size // BUCKET_BYTES))))
    lengths = levels_of(window)
    answered = table
    last = 0
    for level in range(len(lengths)):
        answers = materialize(_ask(answered, window, level, buckets), f"repeats-{level}")
        answered = answered.join(answers, "chunk", "left")
        last = level + 1
        if not _any_alive(answers, level):
            break
    done = last == len(lengths)

    def finish(batches):
        for batch in batches:
            for _, ids, texts, words, repeated in _unpacked(batch, window, last, buckets):
                covered = np.zeros(len(words.hashes) + 1, np.int64)
                if done:
                    np.add.at(covered, repeated, 1)
                    np.add.at(covered, np.minimum(repeated + window, len(covered) - 1), -1)
                gone = np.cumsum(covered)[:-1] > 0
                removed = np.concatenate([[0], np.cumsum(gone)])
                removed = removed[words.first[1:]] - removed[words.first[:-1]]
                kept = []
                stays = (~gone).tolist()
                for i, value in enumerate(texts):
                    parts = value.as_buffer().to_pybytes().split()
                    if removed[i]:
                        parts = compress(parts, stays[words.first[i] : words.first[i + 1]])
                    kept.append(b" ".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], RESULT.names
                )

    return answered.mapInArrow(finish, RESULT)
