import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from turnweave.llm.fingerprints import (
    K,
    containment,
    decode,
    distinct_shingles,
    edited,
    encode,
    merge,
    neighbour_fingerprints,
    resemblance,
    sketches,
    with_fingerprint,
)


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_neighbours_against_a_list(spark):
    draw = random.Random(4)
    texts = {i: " ".join(draw.choice("abcdefgh") for _ in range(draw.choice([0, 1, 4, 60]))) for i in draw.sample(range(10_000), 300)}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in neighbour_fingerprints(frame).collect()}
    order = sorted(texts, reverse=True)
    assert sorted(found, reverse=True) == order
    for doc, following in zip(order, [*order[1:], order[0]]):
        text, row = texts[doc], found[doc]
        m = len(text) // 3
        changed = text[: len(text) - m] + texts[following][:m]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        for other, value in ((changed, row.near_edited), (texts[following], row.near_next)):
            a, b = shingles(text), shingles(other)
            true = len(a & b) / len(a | b) if a | b else 1.0
            assert value == pytest.approx(true) if len(a | b) <= K else abs(value - true) < 0.2
        assert row.fingerprint == encode(sketches(pa.array([text]))[0])


def test_estimates():
    draw = random.Random(8)
    words = [f"w{draw.randrange(10**6)}" for _ in range(9000)]
    a, b = " ".join(words[:6000]), " ".join(words[2000:9000])
    x, y = sketches(pa.array([a, b]), 1024)
    assert resemblance(x, y, 1024) == pytest.approx(4000 / 9000, abs=0.05)
    assert distinct_shingles(x, 1024) == pytest.approx(5996, rel=0.1)
    assert containment(x, y, 1024) == pytest.approx(4 / 6, abs=0.08)
    halves = sketches(pa.array([" ".join(words[:3004]), " ".join(words[3000:6000])]), 1024)
    assert np.array_equal(merge(halves, 1024), x)
    assert np.array_equal(decode(encode(x)), x)


def test_repeats_and_edits():
    values = sketches(pa.array(["a " * 5000, "a a a a a", "", None, "x"]))
    assert [len(v) for v in values] == [1, 1, 0, 0, 1] and np.array_equal(values[0], values[1])
    assert edited("abcdef", "XYZ") == "abcdXY" and edited("abcdef", "") == "abcd" and edited("ab", "Z") == "ab"


def test_odd_tables(odd, nothing, spark):
    found = neighbour_fingerprints(odd)
    assert found.count() == odd.count()
    assert {r.n_chars for r in found.collect() if r.doc_id in (1, 2)} == {0}
    assert len({r.fingerprint for r in found.where("doc_id IN (4, 5)").collect()}) == 1
    assert neighbour_fingerprints(nothing).count() == 0
    lone = neighbour_fingerprints(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).first()
    assert (lone.near_next, lone.near_edited) == (1.0, 0.0)
    assert with_fingerprint(odd).where("fingerprint = ''").count() == 4
