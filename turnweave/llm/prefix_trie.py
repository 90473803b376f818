"""The trie of shared conversation prefixes, rolled up by bands of depth.

A node is a distinct sequence of first turns. Its key is the exclusive or of one hash per turn and
place, twice 64 bits, so keys of all prefixes are running aggregates and a parent's key follows from
its child's: no conversation is gathered. Sums over subtrees go in bands of fixed height: a node
adds its values to its ancestors of the same band at once, and only the completed totals of band
roots go on to the band above. There are as many rounds as bands, and a node makes at most as many
rows as a band is high.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.llm.frames import bounded_batches
from turnweave.operators.ids import dense_ids
from turnweave.session import broadcast_if_small, materialize

FAMILY, MOST_SHARED = 100, 6
#: Depths of a band.
HEIGHT = 16
#: Turns of a conversation whose hashes are summed together, before sums of such spans are.
SPAN = 64
#: Ids of a node that are spelled at once.
SPELLED = 1 << 16

KEY = ["key_a", "key_b", "depth"]
_TEXTS = T.StructType([T.StructField(c, k) for c, k in (("key_a", T.LongType()), ("key_b", T.LongType()), ("depth", T.LongType()), ("first", T.LongType()), ("ids", T.BinaryType()))])
_DIGESTS = T.StructType([T.StructField(c, T.LongType()) for c in KEY] + [T.StructField("ends_sha256", T.StringType())])


def shared_turns(conv_id: Column, most: int = MOST_SHARED) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % most).cast("int")


def numbered_turns(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows ``(conv_id, at, hash_a, hash_b, chars)`` with the place of each turn in its conversation, from 1.

    Turns are in order of their number, null first; those of one number by role, then by a hash of
    the text. Null roles and texts are empty; rows without a conversation are left out. Only
    hashes and lengths of texts are sorted, and a long conversation is sorted by many tasks.
    """
    r, t = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role, text))
    rows = turns.where(F.col(f"`{conv_id}`").isNotNull()).select(
        F.col(f"`{conv_id}`").cast("bigint").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        r.alias("role"),
        F.xxhash64(r, t).alias("hash_a"),
        F.xxhash64(F.lit(1), t, F.lit(2), r).alias("hash_b"),
        F.char_length(t).cast("bigint").alias("chars"),
    )
    placed = dense_ids(rows, "conv_id", "turn", "role", "hash_a", "hash_b", carry=("chars",))
    first = placed.groupBy("conv_id").agg(F.min("id").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("id") - F.col("first") + 1).alias("at"), "hash_a", "hash_b", "chars")


def rebuilt(numbered: DataFrame, family: int = FAMILY, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Conversations ``(conv_id, length)`` and turns ``(conv_id, at, length, hash_a, hash_b, chars)`` of
    the conversations that begin with their family's first turns."""
    own = F.col("conv_id")
    convs = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    convs = convs.select("conv_id", "n", (own - own % family).alias("family"), shared_turns(own, most).alias("shared"))
    heads = (
        numbered.where((own % family == 0) & (F.col("at") < most))
        .groupBy(own.alias("family"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "hash_a", "hash_b", "chars"))).alias("head"))
    )
    convs = convs.join(heads, "family", "left").withColumn("head", F.expr("slice(coalesce(head, array()), 1, shared)"))
    taken = F.size("head")
    convs = convs.select("conv_id", "shared", "head", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("shared"), F.lit(0))).alias("length"))
    convs = materialize(convs, "conversations")
    given = convs.select("conv_id", "length", F.explode("head").alias("h")).select("conv_id", "h.at", "length", "h.hash_a", "h.hash_b", "h.chars")
    after = numbered.join(convs.select("conv_id", "shared", "taken", "length"), "conv_id").where(F.col("at") > F.col("shared"))
    after = after.select("conv_id", (F.col("at") - F.col("shared") + F.col("taken")).alias("at"), "length", "hash_a", "hash_b", "chars")
    return convs.select("conv_id", "length"), given.unionByName(after)


def prefixes(turns: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Rows ``(key_a, key_b, depth, conv_id, chars, ends, up_a, up_b, path)``: each prefix of each
    conversation, the key of its parent, and the keys of its ancestors in its band and itself."""
    here = turns.withColumns(
        {
            "turn_a": F.xxhash64("at", "hash_a", "hash_b"),
            "turn_b": F.xxhash64("hash_b", F.lit(7), "at", "hash_a"),
            "span": F.floor((F.col("at") - 1) / SPAN),
        }
    )
    upto = Window.partitionBy("conv_id", "span").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = here.withColumns({f"key_{x}": F.expr(f"bit_xor(turn_{x})").over(upto) for x in "ab"})
    before = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    spans = here.where(F.col("length") > SPAN).groupBy("conv_id", "span").agg(*[F.expr(f"bit_xor(turn_{x})").alias(f"sum_{x}") for x in "ab"])
    spans = spans.select("conv_id", "span", *[F.expr(f"bit_xor(sum_{x})").over(before).alias(f"sum_{x}") for x in "ab"]).where("span > 0")
    summed = summed.join(broadcast_if_small(materialize(spans, "spans")), ["conv_id", "span"], "left")
    keyed = summed.select(
        "conv_id",
        F.col("at").cast("bigint").alias("depth"),
        "chars",
        (F.col("at") == F.col("length")).alias("ends"),
        *[F.col(f"key_{x}").bitwiseXOR(F.coalesce(f"sum_{x}", F.lit(0))).alias(f"key_{x}") for x in "ab"],
        "turn_a",
        "turn_b",
    ).withColumns({f"up_{x}": F.col(f"key_{x}").bitwiseXOR(F.col(f"turn_{x}")) for x in "ab"})
    in_band = Window.partitionBy("conv_id", F.floor(F.col("depth") / height)).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    path = F.collect_list(F.struct(*KEY)).over(in_band)
    root = F.array(F.struct(*[F.lit(0).cast("bigint").alias(c) for c in KEY]))
    path = F.when(F.col("depth") < height, F.concat(root, path)).otherwise(path)
    return keyed.withColumn("path", path).select(*KEY, "conv_id", "chars", "ends", "up_a", "up_b", "path")


def digests(ends: DataFrame) -> DataFrame:
    """Rows ``(key, ends_sha256)``: the hash of each node's ``conv_id``, ascending and joined by commas.

    Ids are spelled where a range of them is sorted, so those of a frequent node are spelled by many
    tasks; its hash takes the few long texts in order, one at a time.
    """

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, "conv_id")]
            out = []
            for *now, conv_id in zip(*columns):
                if now != key or len(held) == SPELLED:
                    if held:
                        out.append((*key, held[0], ",".join(map(str, held)).encode()))
                    key, held = now, []
                held.append(conv_id)
            if out:
                yield _batch(out, _TEXTS)
        if held:
            yield _batch([(*key, held[0], ",".join(map(str, held)).encode())], _TEXTS)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in (*KEY, "ids")]
            out = []
            for *now, ids in zip(*columns):
                if now == key:
                    state.update(b"," + ids)
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = now, hashlib.sha256(ids)
            if out:
                yield _batch(out, _DIGESTS)
        if key is not None:
            yield _batch([(*key, state.hexdigest())], _DIGESTS)

    spelled = bounded_batches(ends.select(*KEY, "conv_id").orderBy(*KEY, "conv_id")).mapInArrow(spell, _TEXTS)
    return spelled.repartition(*KEY).sortWithinPartitions(*KEY, "first").mapInArrow(digest, _DIGESTS)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.LongType(): pa.int64(), T.BinaryType(): pa.binary(), T.StringType(): pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(x, kinds[f.dataType]) for x, f in zip(zip(*rows), schema)], schema.names)


def rolled_up(nodes: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Rows ``(key, n_leaves, saved_tokens)``: sums over subtrees of ``leaf`` and ``saved``.

    Bands are done from the deepest one; one round each.
    """
    deepest = nodes.agg(F.max("depth")).first()[0]
    totals = incoming = None
    for band in range((deepest or 0) // height, -1, -1):
        here = nodes.where(F.floor(F.col("depth") / height) == band)
        if incoming is not None:
            # What comes from below is added where it arrives, and goes up with the node's own.
            here = here.join(incoming, KEY, "left").withColumns({x: F.col(x) + F.coalesce(f"more_{x}", F.lit(0)) for x in ("leaf", "saved")})
        spread = here.select(F.explode("path").alias("up"), "leaf", "saved").groupBy("up").agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
        done = materialize(spread.select("up.*", "n_leaves", "saved_tokens"), "band-totals")
        totals = done if totals is None else totals.unionByName(done)
        roots = nodes.where(F.col("depth") == band * height).select(*KEY, "up_a", "up_b").join(done, KEY)
        incoming = roots.groupBy(F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b"), (F.col("depth") - 1).alias("depth")).agg(
            F.sum("n_leaves").alias("more_leaf"), F.sum("saved_tokens").alias("more_saved")
        )
    return totals


def prefix_trie(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    family: int = FAMILY,
    most: int = MOST_SHARED,
    height: int = HEIGHT,
) -> DataFrame:
    """Rows ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256)``,
    one for each distinct sequence of first turns of the rebuilt conversations.

    ``conv_id`` is the smallest member, ``saved_tokens`` counts code points. Null roles and texts are
    empty, rows with a null conversation are left out, repeated rows are turns of their own, and turns
    of one number are in order of role and of a hash of the text. No rows give no node, not even
    a root. Other columns are left out.
    """
    numbered = materialize(numbered_turns(turns, conv_id, turn, role, text), "numbered-turns")
    convs, rows = rebuilt(numbered, family, most)
    made = materialize(prefixes(rows, height), "prefixes")
    nodes = made.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        *[F.min(c).alias(c) for c in ("chars", "up_a", "up_b")],
        F.min_by("path", "conv_id").alias("path"),
    )
    none = F.lit(0).cast("bigint")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = top.select(
        *[none.alias(c) for c in KEY], "conv_id", "n_convs", none.alias("chars"), *[F.lit(None).cast("bigint").alias(c) for c in ("up_a", "up_b")],
        F.array(F.struct(*[none.alias(c) for c in KEY])).alias("path"),
    )
    nodes = materialize(nodes.unionByName(root), "nodes")
    children = nodes.where("depth > 0").groupBy(F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "saved": (F.col("n_convs") - 1) * F.col("chars")})
    nodes = materialize(nodes, "trie")
    ended = made.where("ends").select(*KEY, "conv_id").unionByName(convs.where("length = 0").select(*[none.alias(c) for c in KEY], "conv_id"))
    whole = nodes.join(rolled_up(nodes, height), KEY).join(digests(ended), KEY, "left")
    # Every node of depth 1 has the root for parent: its one row is not worth a skewed join.
    least = top.select(F.col("conv_id").alias("root_conv_id"))
    parents = nodes.where("depth > 0").select(F.col("key_a").alias("up_a"), F.col("key_b").alias("up_b"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    low = whole.where("depth > 1").join(parents, ["up_a", "up_b", "depth"])
    high = whole.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, _only(least)))
    empty = hashlib.sha256(b"").hexdigest()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    return low.select(*columns, "ends_sha256").unionByName(high.select(*columns, "ends_sha256")).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(empty)))


def _only(row: DataFrame) -> Column:
    """The value of a table of one row, or null."""
    found = row.first()
    return F.lit(found[0] if found else None).cast("bigint")
