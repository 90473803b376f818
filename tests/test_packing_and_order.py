"""Best-fit packs, exact splits, orders of epochs and summaries that add up."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnweave.catalog import QUERIES
from turnweave.operators import ids, training
from turnweave.operators.summary import summarize
from turnweave.sources.rubrics import BUILT_IN
from turnweave.streaming.summaries import add_batch, kept_summary


def best_fit(lengths, room):
    """Packs of ``(key, length)`` by plain search."""
    packs = []
    for key, length in sorted(lengths, key=lambda x: (-x[1], x[0])):
        fitting = [p for p in packs if sum(n for _, n in p) + length <= room]
        if fitting:
            max(fitting, key=lambda p: (sum(n for _, n in p), -packs.index(p))).append((key, length))
        else:
            packs.append([(key, length)])
    return packs


def test_best_fit_against_plain_search(spark):
    draw = random.Random(2)
    rows = [(i, draw.choice([0, 1, 5, 30, 50, 51, 99, 100, 130])) for i in range(400)]
    frame = spark.createDataFrame(rows, "k long, n_tokens long").repartition(5)
    found = training.pack_sequences(frame, "k", sequence_len=100, shard_rows=50, fit="best").collect()
    shards = defaultdict(list)
    for r in found:
        shards[r.shard].append(r)
    assert len(found) == 400 and len(shards) == 8
    for packed in shards.values():
        expected = best_fit([(r.k, r.n_tokens) for r in packed if r.n_tokens], 100)
        used = lambda packs: sorted(sum(n for _, n in p) for p in packs)
        got = defaultdict(list)
        for r in packed:
            got[r.pack].append(r)
        assert used([[(r.k, r.n_tokens) for r in p if r.n_tokens] for p in got.values() if any(r.n_tokens for r in p)]) == used(expected)
        for p in got.values():
            p.sort(key=lambda r: r.pos)
            assert [r.pos for r in p] == list(range(len(p)))
            assert [r.offset for r in p] == [sum(x.n_tokens for x in p[:i]) for i in range(len(p))]
            assert sum(r.n_tokens for r in p) <= 100 or (len([r for r in p if r.n_tokens]) == 1 and not p[0].fits)
    with pytest.raises(ValueError):
        training.pack_sequences(frame, "k", fit="worst")


@pytest.mark.parametrize("n,share", [(0, 0.5), (1, 0.5), (7, 0.0), (7, 1.0), (1000, 0.02), (1001, 0.333), (50, 0.05)])
def test_exact_split(spark, n, share):
    frame = spark.range(n).select((F.col("id") * 31 + 7).alias("k"), "id").repartition(4)
    rows = training.with_exact_split(frame, "k", share).collect()
    assert len(rows) == n and sum(r.split == "validation" for r in rows) == round(share * n)
    other = training.with_exact_split(frame.repartition(2), "k", share).collect()
    assert {(r.k, r.split) for r in rows} == {(r.k, r.split) for r in other}


def test_exact_split_keeps_a_key_together(spark):
    frame = spark.createDataFrame([(i % 10,) for i in range(100)] + [(None,)] * 5, "k long")
    sides = defaultdict(set)
    rows = training.with_exact_split(frame, "k", 0.25).collect()
    for r in rows:
        sides[r.k].add(r.split)
    assert all(len(s) == 1 for s in sides.values())
    assert 15 <= sum(r.split == "validation" for r in rows) <= 26


@pytest.mark.parametrize("n", [1, 2, 3, 5, 10, 97, 100, 361, 1000])
def test_orders_of_epochs_are_bijections(spark, n):
    rows = ids.with_epoch_order(ids.with_epochs(spark.range(n), 3), n, seed=5).collect()
    orders = defaultdict(dict)
    for r in rows:
        orders[r.epoch][r.id] = r.place
    assert all(sorted(o.values()) == list(range(n)) for o in orders.values())
    if n > 20:
        assert len({tuple(sorted(o.items())) for o in orders.values()}) == 3
        assert all(sum(i == p for i, p in o.items()) < n / 4 for o in orders.values())
    rows_a, columns_a = ids.shuffle_sizes(n)
    assert rows_a * columns_a >= n and rows_a * columns_a - n < max(2, rows_a)


def test_summaries_add_up(spark, tmp_path):
    draw = random.Random(3)
    kind = f"id long, run string, scores map<string,double>"
    keys = BUILT_IN.keys
    rows = [(i, draw.choice("ab"), {k: draw.choice([None, 1.0, 2.5, 5.0]) for k in keys}) for i in range(90)] + [(90, "c", dict.fromkeys(keys))]
    frame = spark.createDataFrame(rows, kind)
    path, run = str(tmp_path / "sums"), (T.StructField("run", T.StringType()),)
    assert kept_summary(spark, path, BUILT_IN, run).count() == 0
    for batch in (0, 1, 2, 1, 1):
        add_batch(frame.where(F.col("id") % 3 == batch), batch, path, BUILT_IN, ("run",))
    rounded = lambda df: sorted(str({**r.asDict(), "category_means": {k: round(v, 9) for k, v in r.category_means.items()}, "overall_mean": round(r.overall_mean, 9)}) for r in df.collect())
    assert rounded(kept_summary(spark, path, BUILT_IN, run)) == rounded(summarize(frame, BUILT_IN, ("run",)))
    # Without a key there is one row, also for no input.
    assert kept_summary(spark, str(tmp_path / "none"), BUILT_IN).first().n == 0


def plain_places(n, epoch, seed):
    """The order of an epoch in plain Python."""
    rows, columns = ids.shuffle_sizes(n)

    def permuted(place):
        left, right = divmod(place, columns)
        for step in range(ids.SHUFFLE_ROUNDS):
            fixed = left if step % 2 else right
            moved = int(hashlib.md5("|".join([str(seed), *([] if epoch is None else [str(epoch)]), str(step), str(fixed)]).encode()).hexdigest()[:8], 16)
            left, right = (left, (right + moved) % columns) if step % 2 else ((left + moved) % rows, right)
        return left * columns + right

    def place(row):
        found = permuted(row)
        while found >= n:
            found = permuted(found)
        return found

    return [place(row) for row in range(n)]


def test_order_of_epochs_against_plain_python(spark):
    frame = ids.with_epochs(spark.range(47), 3).unionByName(spark.range(47).withColumn("epoch", F.lit(None).cast("int")))
    # Rows may come twice, and columns named as the new one are replaced.
    twice = frame.unionByName(frame).withColumn("place", F.lit("x"))
    rows = ids.with_epoch_order(twice, 47, seed=3)
    assert rows.columns == ["id", "epoch", "place"]
    expected = [(i, e, p) for e in (1, 2, 3, None) for i, p in enumerate(plain_places(47, e, 3))] * 2
    assert sorted(map(str, rows.collect())) == sorted(f"Row(id={i}, epoch={e}, place={p})" for i, e, p in expected)
    assert ids.with_epoch_order(twice.limit(0), 0).count() == 0
    with pytest.raises(Exception, match="no place found"):
        ids.with_epoch_order(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 1 AS epoch"), 47).collect()


def test_an_order_is_computed_once_a_row_and_compiled(spark):
    plan = ids.with_epoch_order(ids.with_epochs(spark.range(1000), 3), 1000)._jdf.queryExecution().executedPlan().toString()
    looped = next(line for line in plan.splitlines() if "aggregate(" in line)
    # The loop begins with a column of the step before it, and is only for rows beyond the table.
    assert re.search(r"CASE WHEN \(_first#\d+L < 1000\) THEN _first#\d+L ELSE aggregate\([^,]*, _first#\d+L, ", looped)
    compiled = [line for line in plan.splitlines() if "md5(" in line and re.match(r"\W*\*\(\d+\) Project", line)]
    assert len(compiled) == 1 and "aggregate(" not in compiled[0]


def test_rows_of_a_full_partition_are_dealt_anew(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(ids, "TASK_ROWS", 100)
    sizes = lambda df: [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    rows = lambda df: sorted(map(str, df.collect()))
    # One key has most of the rows, so one task sorts them.
    uneven = spark.range(0, 900, 1, 1).union(spark.range(900, 1000, 1, 3)).select("id", F.lit(None).cast("string").alias("k"))
    dealt, n = ids.dealt_by_rows(uneven)
    assert n == 1000 and max(sizes(uneven)) == 900 and max(sizes(dealt)) < 200 and len(sizes(dealt)) == 10
    assert rows(dealt) == rows(uneven)
    # Other rows stay where they are.
    even = spark.range(0, 597, 1, 3)
    same, n = ids.dealt_by_rows(even)
    assert same is even and n == 597
    nothing, n = ids.dealt_by_rows(spark.range(0))
    assert n == 0 and nothing.count() == 0
    # The order of epochs is the same, whoever computes it; equal keys and null ones are rows of their own.
    turns = [(7, 0, "user")] * 500 + [(None, 0, "user"), (None, None, "user"), (3, None, "user")] * 5 + [(i, 2, "user") for i in range(40)] + [(7, 1, "assistant")] * 9
    spark.createDataFrame(turns, "conv_id long, turn long, role string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    ordered = QUERIES["epoch_order"](spark, str(tmp_path))
    assert "hashpartitioning(id" in ordered._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ids, "TASK_ROWS", 10**6)
    kept = QUERIES["epoch_order"](spark, str(tmp_path))
    assert "hashpartitioning(id" not in kept._jdf.queryExecution().executedPlan().toString()
    assert rows(ordered) == rows(kept) and ordered.count() == 3 * 555
