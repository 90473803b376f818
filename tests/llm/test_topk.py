"""Top-k search against plain Python."""

import math
import random

import pytest

from turnweave.llm import topk
from turnweave.llm.topk import top_k


def plain(rows, k, step):
    used = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and all(x is not None and abs(x) * 256 < topk.LARGEST for x in v)]
    queries = {(i, tuple(v)) for i, v in used if i is not None and i % step == 0}
    out = []
    for i, q in queries:
        scored = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, v in used if j != i and len(v) == len(q))
        out += [(i, rank + 1, None if unknown else j, -s) for rank, (s, unknown, j) in enumerate(scored[:k])]
    return sort(out)


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def found(spark, rows, monkeypatch, k=5, step=7, block=16):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string").repartition(4)
    return sort(tuple(r) for r in top_k(frame, k=k, step=step).collect())


@pytest.mark.parametrize("scale,dims", [(0.3, 8), (60_000.0, 3), (0.003, 4)])
def test_against_plain_python(spark, monkeypatch, scale, dims):
    draw = random.Random(dims)
    rows = [(i, [draw.uniform(-scale, scale) for _ in range(dims)]) for i in draw.sample(range(-300, 300), 200)]
    assert found(spark, rows, monkeypatch) == plain(rows, 5, 7)


def test_ties_repeats_and_odd_vectors(spark, monkeypatch):
    same = [0.5, 0.25]
    rows = [(i, same) for i in range(60)]  # one large group of copies
    rows += [(7, same), (14, [1.0, -1.0]), (61, same), (61, same), (None, same), (None, [9.0, 9.0])]
    rows += [(70, None), (77, []), (84, [None, 1.0]), (91, [math.nan, 1.0]), (98, [math.inf, 1.0]), (105, [1e9, 1.0]), (112, [0.0, 0.0]), (119, [1.0])]
    assert found(spark, rows, monkeypatch) == plain(rows, 5, 7)


def test_fewer_than_k_and_none(spark, monkeypatch):
    rows = [(0, [1.0, 2.0]), (1, [3.0, 4.0]), (2, [-5.0, 1.0]), (7, [0.5, 0.5])]
    assert found(spark, rows, monkeypatch, k=10) == plain(rows, 10, 7)
    assert found(spark, rows[:1], monkeypatch) == []
    assert found(spark, [], monkeypatch) == []
    assert found(spark, [(1, [1.0]), (2, [1.0])], monkeypatch) == []
