"""Similarity join of documents by the Jaccard index of their word shingles.

Rare-first prefix filtering: a document's shingles are put in one order for all documents, rare ones
first by a count over the whole corpus. Two documents that are similar enough share one of the first
``n - ceil(t n) + 1``, so only those prefix shingles are joined. Pairs then have to pass a length,
a positional and a suffix filter, and each one left is verified once on the full sets.

Copies are one class from the start. Within a class of near copies not all pairs are made: each
document is first compared with one leader, and then only with documents that it is not
connected with yet, which leaves every link that could join two components.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches
from turnweave.llm.words import FOLDED, lists, mix, slices, words_of
from turnweave.session import broadcast_if_small, materialize

SHINGLE = 5
THRESHOLD = Fraction(4, 5)

#: Counters of the shingle counts, sent to every task: 4 bytes each. Shingles may share one, which
#: blurs the order, never the result.
SLOTS = 1 << 22
SLOT_BLOCK = 1 << 16
SUM_FAN = 256
#: Prefix shingles gathered in one task.
BUCKET_ENTRIES = 1_000_000
#: From twice the mean of the counters plus this on, a shingle may be too frequent for one task.
HOT_COUNT = 10_000
#: Lists of a shingle with more classes are compared in blocks within tasks, by short profiles.
LONG_LIST, LIST_BLOCK, BRIEF = 32, 1024, 64
#: Rows of 16 bytes that may be broadcast.
BROADCAST_IDS = 1_000_000

_LONG, _INT, _BIN = T.LongType(), T.IntegerType(), T.BinaryType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SETS = _schema(key=_LONG, n=_INT, grams=_BIN)
PREFIXES = _schema(doc_id=_LONG, mark=_LONG, key=_LONG, n=_INT, weight=_INT, hot_from=_INT, prefix=T.ArrayType(_LONG), profile=_BIN)
ENTRIES = _schema(gram=_LONG, key=_LONG, n=_INT, weight=_INT, pos=_INT)


class ShingleSets:
    """Distinct shingles of some texts: ``grams`` in order of text and hash, ``counts`` of each text."""

    def __init__(self, texts: pa.Array, shingle: int):
        words = words_of(texts, FOLDED)
        places, grams = words.windows(shingle)
        owner = np.searchsorted(words.first, places, side="right") - 1
        short = np.flatnonzero((words.counts > 0) & (words.counts < shingle))
        grams = np.concatenate([grams, words.whole()[short]])
        owner = np.concatenate([owner, short])
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
        self.grams, self.owner = grams[new], owner[new]
        self.counts = np.bincount(self.owner, minlength=len(words.counts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])

    def keys(self) -> np.ndarray:
        """A hash of each set."""
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.grams + np.uint64(0x51)))])
        return mix(sums[self.first[1:]] - sums[self.first[:-1]] + self.counts.astype(np.uint64)).view(np.int64)


def prefix_length(n: np.ndarray, threshold: Fraction) -> np.ndarray:
    """How many of a set's first shingles it may share one of with a similar set."""
    least = -(-n * threshold.numerator // threshold.denominator)
    return np.where(n > 0, n - least + 1, 0)


def shingle_counts(docs: DataFrame, text: str, shingle: int) -> np.ndarray:
    """For each counter, in how many documents its shingles are."""

    def count(batches):
        counters = np.zeros(SLOTS, np.uint32)
        for batch in slices(batches, text):
            slot = ShingleSets(batch.column(text), shingle).grams & np.uint64(SLOTS - 1)
            np.add.at(counters, slot.astype(np.int64), 1)
        if counters.any():
            yield packed(counters.reshape(-1, SLOT_BLOCK), range(SLOTS // SLOT_BLOCK))

    def packed(rows, blocks) -> pa.RecordBatch:
        data = [zlib.compress(row.tobytes(), 1) for row in rows]
        return pa.RecordBatch.from_arrays([pa.array(list(blocks), pa.int32()), pa.array(data, pa.binary())], ["block", "counters"])

    def total(table: pa.Table) -> pa.Table:
        sums = np.zeros(SLOT_BLOCK, np.uint64)
        for data in table.column("counters"):
            sums += np.frombuffer(zlib.decompress(data.as_py()), np.uint32)
        sums = np.minimum(sums, np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return pa.Table.from_batches([packed([sums], [table.column("block")[0].as_py()])])

    schema = _schema(block=_INT, counters=_BIN)
    parts = docs.select(text).mapInArrow(count, schema)
    # Two steps, so that no task sums more than a share of all tasks' counters.
    some = parts.groupBy("block", F.pmod(F.spark_partition_id(), F.lit(SUM_FAN))).applyInArrow(total, schema)
    counters = np.zeros((SLOTS // SLOT_BLOCK, SLOT_BLOCK), np.uint32)
    for row in some.groupBy("block").applyInArrow(total, schema).toLocalIterator():
        counters[row.block] = np.frombuffer(zlib.decompress(row.counters), np.uint32)
    return counters.reshape(-1)


def profile(grams: np.ndarray) -> bytes:
    """How many of a set's shingles lie in each of equal ranges of hashes, one to three in one."""
    bits = max(2, int(len(grams) // 2).bit_length())
    return np.bincount((grams >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint16).tobytes()


def most_common(a: bytes, b: bytes) -> int:
    """An upper bound of the shingles two sets have in common."""
    x, y = np.frombuffer(a, np.uint16).astype(np.int64), np.frombuffer(b, np.uint16).astype(np.int64)
    if len(x) > len(y):
        x = x.reshape(len(y), -1).sum(axis=1)
    elif len(y) > len(x):
        y = y.reshape(len(x), -1).sum(axis=1)
    return int(np.minimum(x, y).sum())


def brief(whole: bytes) -> bytes:
    """A profile in ``BRIEF`` ranges of one byte each; all 255, which rules nothing out, if a count
    does not fit."""
    counts = np.frombuffer(whole, np.uint16).astype(np.int64)
    if len(counts) > BRIEF:
        counts = counts.reshape(BRIEF, -1).sum(axis=1)
    elif len(counts) < BRIEF:
        # Few shingles: each may be anywhere in its range's part.
        return b"\xff" * BRIEF
    return counts.astype(np.uint8).tobytes() if counts.max() < 255 else b"\xff" * BRIEF


def located(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows ``(_id, _mark, _text)``; the mark is a hash of the text, as ids may be null or repeated."""
    return docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_mark"), F.col(f"`{text}`").alias("_text"))


def prefixes(docs: DataFrame, counts: np.ndarray, doc_id: str, text: str, shingle: int, threshold: Fraction) -> DataFrame:
    """One row per document: its text's hash, class, set size, prefix in rare-first order and profile.

    ``weight`` grows with the frequency of its prefix shingles: of near copies, the one with the fewest
    shingles of its own has the most of it.
    """
    sent = docs.sparkSession.sparkContext.broadcast(counts)
    hot = 2 * float(counts.mean()) + HOT_COUNT

    def make(batches):
        for batch in slices(batches, "_text"):
            sets = ShingleSets(batch.column("_text"), shingle)
            often = sent.value[(sets.grams & np.uint64(SLOTS - 1)).astype(np.int64)]
            order = np.lexsort((sets.grams, often, sets.owner))
            rank = np.arange(len(order)) - np.repeat(sets.first[:-1], sets.counts)
            size = prefix_length(sets.counts, threshold)
            chosen = order[rank < size[sets.owner]]
            weight = np.bincount(sets.owner[chosen], 16 * np.log2(1.0 + often[chosen]), minlength=len(size))
            calm = np.bincount(sets.owner[chosen], often[chosen] < hot, minlength=len(size))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_mark"),
                    pa.array(sets.keys(), pa.int64()),
                    pa.array(sets.counts, pa.int32()),
                    pa.array(weight.astype(np.int32), pa.int32()),
                    pa.array(calm.astype(np.int32), pa.int32()),
                    lists(sets.grams[chosen].view(np.int64), size, pa.int64()),
                    pa.array([profile(sets.grams[a:b]) for a, b in zip(sets.first[:-1], sets.first[1:])], pa.binary()),
                ],
                PREFIXES.names,
            )

    rows = located(docs, doc_id, text)
    return rows.mapInArrow(make, PREFIXES)


def shared_entries(table: DataFrame) -> DataFrame:
    """Rows ``(gram, key, n, pos)`` of prefix shingles that two classes have.

    Shingles travel packed, by bucket, with 48 bits of their hash besides the bucket's; two that
    agree by chance only add a pair to be filtered. Those that may be very frequent go by themselves.
    """
    spark = table.sparkSession
    total = table.agg(F.sum("hot_from")).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET_ENTRIES))

    def pack(batches):
        for batch in batches:
            keys, rows = np.unique(batch.column("key").to_numpy(), return_index=True)
            for at in range(0, len(rows), 65536):
                yield from packed(batch, rows[at : at + 65536])

    def packed(batch, rows):
        prefix = batch.column("prefix")
        first = prefix.offsets.to_numpy()
        calm = batch.column("hot_from").to_numpy()[rows].astype(np.int64)
        owner = np.repeat(np.arange(len(rows)), calm)
        pos = np.arange(calm.sum()) - np.repeat(np.cumsum(calm) - calm, calm)
        grams = prefix.values.to_numpy().view(np.uint64)[np.repeat(first[:-1][rows], calm) + pos]
        bucket = (mix(grams) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
        key, *sizes = (batch.column(c).to_numpy()[rows] for c in ("key", "n", "weight"))
        out: list[list] = [[], [], []]
        for b in np.flatnonzero(np.diff(edges)).tolist():
            some = order[edges[b] : edges[b + 1]]
            docs, index = np.unique(owner[some], return_inverse=True)
            raw = grams[some].view(np.uint8).reshape(-1, 8)[:, :6]
            body = [np.ascontiguousarray(raw), index.astype(np.uint16), np.minimum(pos[some], 65535).astype(np.uint16)]
            out[0].append(b)
            out[1].append(b"".join(x.tobytes() for x in body))
            out[2].append(key[docs].tobytes() + b"".join(x[docs].astype(np.int32).tobytes() for x in sizes))
        kinds = [pa.int32(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], ["bucket", "entries", "classes"])

    def meet(rows: pa.Table) -> pa.Table:
        parts: list[list[np.ndarray]] = [[], [], [], [], []]
        for entries, classes in zip(rows.column("entries"), rows.column("classes")):
            entries, classes = entries.as_buffer(), classes.as_buffer()
            m, d = entries.size // 10, classes.size // 16
            raw = np.frombuffer(entries, np.uint8)
            grams = np.zeros((m, 8), np.uint8)
            grams[:, :6] = raw[: 6 * m].reshape(-1, 6)
            index = raw[6 * m : 8 * m].view(np.uint16)
            key = np.frombuffer(classes, np.int64, d)
            n, weight = np.frombuffer(classes, np.int32, 2 * d, 8 * d).reshape(2, d)
            columns = (grams.reshape(-1).view(np.uint64), key[index], n[index], weight[index], raw[8 * m :].view(np.uint16))
            for part, values in zip(parts, columns):
                part.append(values)
        whole = [np.concatenate(p) for p in parts]
        order = np.lexsort((whole[1], whole[0]))
        gram, key = whole[0][order], whole[1][order]
        fresh = np.ones(len(gram), bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])
        gram, key, n, weight, pos = (x[order][fresh] for x in whole)
        same = gram[1:] == gram[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        columns = [gram[shared].view(np.int64), key[shared], *(x[shared].astype(np.int32) for x in (n, weight, pos))]
        # The bucket is part of what tells shingles apart.
        columns[0] = mix(columns[0].view(np.uint64) ^ mix(np.full(len(columns[0]), rows.column("bucket")[0].as_py(), np.uint64))).view(np.int64)
        return pa.table([pa.array(c) for c in columns], names=ENTRIES.names)

    calm = (
        table.where("hot_from > 0")
        .select("key", "n", "weight", "hot_from", "prefix")
        .mapInArrow(pack, _schema(bucket=_INT, entries=_BIN, classes=_BIN))
        .groupBy("bucket")
        .applyInArrow(meet, ENTRIES)
    )
    hot = (
        table.where(F.size("prefix") > F.col("hot_from"))
        .select("key", "n", "weight", "hot_from", F.posexplode("prefix").alias("pos", "gram"))
        .where("pos >= hot_from")
        .select("gram", "key", "n", "weight", "pos")
        .dropDuplicates(["gram", "key"])
    )
    return calm.unionByName(hot)


def may_be_similar(na: Column, pa_: Column, nb: Column, pb: Column, threshold: Fraction) -> Column:
    """Length and positional filter of a pair that meets at these places of its prefixes."""
    p, q = threshold.numerator, threshold.denominator
    lengths = (F.least(na, nb) * q >= F.greatest(na, nb) * p) & (na > 0)
    return lengths & (F.least(na - pa_, nb - pb) * (p + q) >= (na + nb) * p)


def leader_pairs(entries: DataFrame, threshold: Fraction) -> DataFrame:
    """Rows ``(a, b)``: for each class the leader with which it shares most prefix shingles.

    A shingle's leader is the class of the greatest weight in its list: the one in the middle of near copies.
    """
    leaders = entries.groupBy("gram").agg(F.max(F.struct("weight", "key", "n", "pos")).alias("lead"))
    met = entries.join(leaders, "gram").where(
        (F.col("key") != F.col("lead.key"))
        & may_be_similar(F.col("n"), F.col("pos"), F.col("lead.n"), F.col("lead.pos"), threshold)
    )
    counted = met.groupBy(F.col("lead.key").alias("a"), F.col("key").alias("b")).agg(F.count(F.lit(1)).alias("common"))
    return counted.groupBy("b").agg(F.max(F.struct("common", "a")).alias("best")).select(F.col("best.a").alias("a"), "b")


def open_pairs(entries: DataFrame, labels: DataFrame, table: DataFrame, threshold: Fraction) -> DataFrame:
    """Rows ``(a, b)``: pairs of classes that meet in a prefix and are not connected yet.

    In a shingle's list, classes outside its largest component meet all others; the large
    component is not paired with itself. Long lists make no rows of pairs: see ``in_blocks``.
    """
    named = entries.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    named = materialize(named, "named-entries")
    per_label = named.groupBy("gram", "label").agg(F.count(F.lit(1)).alias("size"))
    mixed = materialize(
        per_label.groupBy("gram")
        .agg(
            F.max(F.struct("size", "label")).alias("most"),
            F.count(F.lit(1)).alias("labels"),
            F.sum("size").alias("size"),
        )
        .where("labels > 1")
        .select("gram", "size", F.col("most.label").alias("major"), F.col("most.size").alias("major_size")),
        "open-shingles",
    )
    here = named.join(mixed.where(F.col("size") <= LONG_LIST), "gram")
    x = here.select("gram", *[F.col(c).alias(f"x_{c}") for c in ("key", "n", "pos", "label", "major")])
    y = here.where("label <> major").select("gram", *[F.col(c).alias(f"y_{c}") for c in ("key", "n", "pos", "label")])
    met = x.join(y, "gram").where(
        (F.col("x_label") != F.col("y_label"))
        & ((F.col("x_label") == F.col("x_major")) | (F.col("x_key") < F.col("y_key")))
        & may_be_similar(F.col("x_n"), F.col("x_pos"), F.col("y_n"), F.col("y_pos"), threshold)
    )
    short = met.select(F.least("x_key", "y_key").alias("a"), F.greatest("x_key", "y_key").alias("b"))
    long = in_blocks(named.join(mixed.where(F.col("size") > LONG_LIST), "gram"), table, threshold)
    return short.unionByName(long).distinct()


def dealt_to_blocks(rows: DataFrame) -> DataFrame:
    """Rows of long lists with the blocks ``low`` and ``high`` that meet in a task, one of them ``own``.

    Classes of the list's largest component are in blocks below 0, the other ones in blocks from 0 on,
    each of about ``LIST_BLOCK`` classes. Every block meets those from 0 on only: the large component is
    not compared with itself, and is dealt once where one block holds all classes outside it.
    """
    inner = F.col("label") == F.col("major")
    inner_blocks = F.ceil(F.col("major_size") / LIST_BLOCK).cast("int")
    outer_blocks = F.ceil((F.col("size") - F.col("major_size")) / LIST_BLOCK).cast("int")
    place = F.xxhash64("key")
    own = F.when(inner, -1 - F.pmod(place, inner_blocks)).otherwise(F.pmod(place, outer_blocks)).cast("int")
    others = F.sequence(F.when(inner, F.lit(0)).otherwise(-inner_blocks), outer_blocks - 1)
    return (
        rows.withColumns({"own": own, "other": others})
        .withColumn("other", F.explode("other"))
        .withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
        .drop("other")
    )


def in_blocks(rows: DataFrame, table: DataFrame, threshold: Fraction) -> DataFrame:
    """Pairs from long lists that pass all filters, short profiles included.

    Blocks of a list (``dealt_to_blocks``) meet two by two in a task of their own, where pairs are
    compared as arrays; only those that pass become rows.
    """
    p, q = threshold.numerator, threshold.denominator

    def shorten(batches):
        for batch in batches:
            made = [brief(x.as_py()) for x in batch.column("profile")]
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(made, pa.binary())], ["key", "brief"])

    wanted = broadcast_if_small(rows.select("key").distinct(), BROADCAST_IDS)
    profiles = table.select("key", "profile").join(wanted, "key").dropDuplicates(["key"]).mapInArrow(shorten, _schema(key=_LONG, brief=_BIN))
    dealt = dealt_to_blocks(rows.join(profiles, "key")).select("gram", "low", "high", "own", "key", "n", "pos", "label", "brief")

    def compare(group: pa.Table) -> pa.Table:
        own, key, n, pos, label = (group.column(c).to_numpy() for c in ("own", "key", "n", "pos", "label"))
        n, pos = n.astype(np.int64), pos.astype(np.int64)
        shape = np.frombuffer(b"".join(x.as_py() for x in group.column("brief")), np.uint8).reshape(-1, BRIEF)
        low, high = (group.column(c)[0].as_py() for c in ("low", "high"))
        found: list[list[np.ndarray]] = [[], []]
        for i in np.flatnonzero(own == high).tolist():
            others = np.flatnonzero((label != label[i]) & (key > key[i] if low == high else own == low))
            sizes = n[others] + n[i]
            fits = (np.minimum(n[others], n[i]) * q >= np.maximum(n[others], n[i]) * p) & (
                np.minimum(n[others] - pos[others], n[i] - pos[i]) * (p + q) >= sizes * p
            )
            others, sizes = others[fits], sizes[fits]
            if len(others):
                common = np.minimum(shape[others], shape[i]).sum(axis=1, dtype=np.int64)
                others = others[(common * (p + q) >= sizes * p) | (shape[others, 0] == 255) | (shape[i, 0] == 255)]
                found[0].append(np.minimum(key[others], key[i]))
                found[1].append(np.maximum(key[others], key[i]))
        a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in found)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.groupBy("gram", "low", "high").applyInArrow(compare, _schema(a=_LONG, b=_LONG))


class Verifier:
    """Checks pairs of classes on profiles and then on full sets, computed again from the texts."""

    def __init__(self, docs: DataFrame, table: DataFrame, doc_id: str, text: str, shingle: int, threshold: Fraction):
        self.docs = located(docs, doc_id, text)
        self.table, self.shingle, self.threshold = table, shingle, threshold

    def links(self, pairs: DataFrame) -> DataFrame:
        left = materialize(self.passing(pairs), "candidate-pairs")
        by_b = left.join(self.sets(left.select(F.col("b").alias("key"))), F.col("b") == F.col("key")).select("a", "b", F.col("grams").alias("of_b"))
        sets_a = self.sets(left.select(F.col("a").alias("key"))).select(F.col("key").alias("a"), F.col("grams").alias("of_a"))
        p, q = self.threshold.numerator, self.threshold.denominator

        def compare(batches):
            for batch in batches:
                keep = []
                for a, b in zip(batch.column("of_a"), batch.column("of_b")):
                    a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(q * common >= p * (len(a) + len(b) - common))
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return by_b.join(sets_a, "a").select("a", "b", "of_a", "of_b").mapInArrow(compare, _schema(a=_LONG, b=_LONG))

    def passing(self, pairs: DataFrame) -> DataFrame:
        """Pairs that the suffix filter leaves."""
        profiles = self.table.select("key", "n", "profile").dropDuplicates(["key"])
        both = pairs
        for side in ("a", "b"):
            both = both.join(profiles.toDF(side, f"n_{side}", f"profile_{side}"), side)
        p, q = self.threshold.numerator, self.threshold.denominator

        def bound(batches):
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "profile_a", "profile_b")]
                keep = [(p + q) * most_common(x, y) >= p * (na + nb) for na, nb, x, y in zip(*columns)]
                yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        return both.select("a", "b", "n_a", "n_b", "profile_a", "profile_b").mapInArrow(bound, _schema(a=_LONG, b=_LONG))

    def texts(self, keys: DataFrame) -> DataFrame:
        """Rows ``(key, _text)`` of one document of each class. Rows of one id are told apart by their
        texts' hashes, so a document is met by one class, however many rows share its id."""
        wanted = broadcast_if_small(keys.distinct(), BROADCAST_IDS)
        one = F.min(F.struct("mark", "doc_id")).alias("one")
        members = self.table.select("key", "mark", "doc_id").join(wanted, "key").groupBy("key").agg(one).select("key", "one.mark", "one.doc_id")
        members = broadcast_if_small(materialize(members, "class-members"), BROADCAST_IDS)
        here = (F.col("_mark") == F.col("mark")) & F.col("_id").eqNullSafe(F.col("doc_id"))
        return self.docs.join(members, here).select("key", "_text")

    def sets(self, keys: DataFrame) -> DataFrame:
        """Rows ``(key, grams)`` of the given classes, each from one of its documents."""
        shingle = self.shingle

        def make(batches):
            for batch in slices(batches, "_text"):
                sets = ShingleSets(batch.column("_text"), shingle)
                made = sets.keys()
                rows = np.flatnonzero(made == batch.column("key").to_numpy())
                grams = [sets.grams[sets.first[i] : sets.first[i + 1]].tobytes() for i in rows.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(made[rows], pa.int64()), pa.array(grams, pa.binary())], ["key", "grams"])

        found = self.texts(keys).mapInArrow(make, _schema(key=_LONG, grams=_BIN))
        return found.dropDuplicates(["key"])


def components(links: DataFrame) -> DataFrame:
    """Rows ``(key, label)``: the smallest key connected with each key that has a link.

    Each round hangs a node's larger neighbours, and then its smaller ones and itself, on the smallest
    among them; edges end up as stars. Rounds grow with the logarithm of a component's width.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = large.select("u", "v")
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(small_least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        edges = materialize(hung, "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("key"), F.col("v").alias("label"))
        state = now


def similar_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: Fraction = THRESHOLD
) -> DataFrame:
    """Rows ``(doc_id, n_shingles, component_id)``, one per document.

    ``component_id`` is the smallest id among all documents that links lead to, its own included.
    Shingles are those of white-space separated words with A-Z in lower case; a text with fewer words
    than a shingle has is one shingle. Null and empty texts have no shingle and are linked with nothing.
    Rows with a null id take part and never name a group, unless all of it is without id; rows of
    one id are judged by their own texts. An empty table gives no rows.
    """
    return labelled_rows(docs, doc_id, text, shingle, threshold).select("doc_id", "n_shingles", "component_id")


def labelled_rows(docs: DataFrame, doc_id: str, text: str, shingle: int, threshold: Fraction) -> DataFrame:
    """Rows ``(doc_id, mark, n_shingles, label, component_id)``, one per document: its text's hash and its group."""
    if not isinstance(docs.schema[doc_id].dataType, T.IntegralType):
        raise TypeError(f"{doc_id} must be a column of whole numbers")
    docs = bounded_batches(docs).select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    doc_id, text = "doc_id", "text"
    counts = shingle_counts(docs, text, shingle)
    table = materialize(prefixes(docs, counts, doc_id, text, shingle, threshold), "prefixes")
    entries = materialize(shared_entries(table), "shared-shingles")
    verifier = Verifier(docs, table, doc_id, text, shingle, threshold)
    tried = materialize(leader_pairs(entries, threshold), "leader-pairs")
    links = materialize(verifier.links(tried), "leader-links")
    labels = components(links)
    rest = open_pairs(entries, labels, table, threshold).join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    more = materialize(verifier.links(rest), "further-links")
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    return named_groups(table, labels)


def named_groups(table: DataFrame, labels: DataFrame) -> DataFrame:
    classes = table.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("least"))
    labelled = classes.join(labels, "key", "left").withColumn("label", F.coalesce("label", "key"))
    groups = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_key = labelled.join(groups, "label").select("key", "label", "component_id")
    rows = table.select("doc_id", "mark", F.col("n").cast("bigint").alias("n_shingles"), "key")
    linked = rows.where("n_shingles > 0").join(by_key, "key").drop("key")
    alone = rows.where("n_shingles = 0").drop("key").withColumns({"label": F.lit(None).cast("bigint"), "component_id": F.col("doc_id")})
    return linked.unionByName(alone)


def one_of_each_group(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, threshold: Fraction = THRESHOLD
) -> DataFrame:
    """The documents, of each group of similar ones only one: of the rows with the smallest id that of the
    smallest text hash, and one of those that repeat it.

    Rows without shingles stay, and so do rows with a null id. Rows are judged by their own
    text, so other texts under a dropped row's id stay if nothing is similar to them.
    """
    rows = labelled_rows(docs, doc_id, text, shingle, threshold).where("n_shingles > 0 AND doc_id IS NOT NULL")
    rows = materialize(rows.groupBy("label", F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.count(F.lit(1)).alias("n")), "groups")
    first = rows.groupBy("label").agg(F.min(F.struct("_id", "_mark")).alias("first"))
    # Groups of one text need no decision.
    judged = materialize(
        rows.join(first, "label").select("_id", "_mark", "n", (F.struct("_id", "_mark") == F.col("first")).alias("stays")).where("NOT stays OR n > 1"),
        "judged-texts",
    )
    columns = [f"c{i}" for i in range(len(docs.columns))]
    here = docs.toDF(*columns).withColumns({"_id": F.col(columns[docs.columns.index(doc_id)]).cast("bigint"), "_mark": F.xxhash64(columns[docs.columns.index(text)])})
    kept = here.join(broadcast_if_small(judged.select("_id", "_mark"), BROADCAST_IDS), ["_id", "_mark"], "left_anti")
    again = judged.where("stays").select("_id", "_mark")
    if not again.isEmpty():
        once = here.join(broadcast_if_small(again, BROADCAST_IDS), ["_id", "_mark"], "left_semi")
        once = once.groupBy("_id", "_mark").agg(F.first(F.struct(*columns)).alias("row")).select("_id", "_mark", "row.*")
        kept = kept.unionByName(once)
    return kept.select(*columns).toDF(*docs.columns)
