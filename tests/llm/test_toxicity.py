import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from turnweave.llm import toxicity
from turnweave.llm.toxicity import drop_toxic, fit, held_out, labelled_sample, score_toxicity, train

SF_DIR = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{SF_DIR}/{name}.parquet") for name in ("documents", "labels")]


def test_held_out_accuracy(tables):
    docs, labels = tables
    scored = score_toxicity(docs, fit(docs, labels)).join(labels, "doc_id").where(held_out(F.col("doc_id")))
    counts = {(r.toxic, r.predicted): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((1, 1), 0) >= 0.85 * (counts.get((1, 1), 0) + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.01 * counts[0, 0]


def test_unseen_spellings():
    draw = np.random.default_rng(1)
    words = ["cat", "dog", "bird", "man", "hill", "road", "went", "over", "under", "home", "the", "that"]
    clean = [" ".join(draw.choice(words, 12)) for _ in range(80)]
    insults = ["idiotic", "idiots", "idiotly", "idiotish", "idiot"]
    toxic = [" ".join([*draw.choice(words, 10), draw.choice(insults), draw.choice(insults)]) for _ in range(40)]
    model = train(pa.array(clean + toxic), np.array([0] * len(clean) + [1] * len(toxic)))
    seen, unseen, fine = model.scores(pa.array(["the cat idiot went home", "that idiotz idiotnik went home", "the cat went over the hill"]))
    assert seen > 0.5 > fine and unseen > 0.5


def test_fold(spark):
    rows = spark.range(200).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


def test_sample_never_holds_the_fold(tables):
    docs, labels = tables
    rows = labelled_sample(docs, labels, per_class=50).collect()
    texts = {r.text for r in rows}
    assert 50 <= len(texts) <= 100 and {r.label for r in rows} == {0, 1}
    fold = {r.text for r in docs.where(held_out(F.col("doc_id"))).join(labels, "doc_id").collect()}
    rest = {r.text for r in docs.where(~held_out(F.col("doc_id"))).join(labels, "doc_id").collect()}
    assert texts <= rest and not texts & (fold - rest)


def test_sample_of_repeated_ids_is_bounded(spark):
    one = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 5)
    rows = [(one, f"text {n % 50}") for n in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(one, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, per_class=20).collect()
    assert len({r.text for r in rows}) == len(rows) == 20 and {r.label for r in rows} == {1}
    assert labelled_sample(docs, labels).count() == 50


def test_sample_is_bounded_in_bytes_and_keeps_long_texts(spark):
    rows = [(i, "long " * 200_000 if i % 40 == 1 else f"text {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    whole = labelled_sample(docs, labels).collect()
    assert max(len(r.text) for r in whole) == 1_000_000
    less = labelled_sample(docs, labels, sample_bytes=1000).collect()
    assert 100 < sum(len(r.text) for r in less) <= 1000 and {r.text for r in less} < {r.text for r in whole}
    assert labelled_sample(docs, labels.where("false")).count() == 0


def test_gradient_step_against_finite_differences():
    """One step moves each number against the slope of the mean loss, as differences of the loss give it."""
    draw = np.random.default_rng(3)
    bags = toxicity.bags_of(pa.array(["abcd bcde", "cdef abcd efgh", "zz"]))
    begin, width, target = np.array([0, 2, 5]), np.array([2, 3, 1]), np.array([0, 1, 1])
    vectors = draw.normal(size=(toxicity.BUCKETS, toxicity.DIMENSIONS))
    output, bias = draw.normal(size=(toxicity.DIMENSIONS, 2)), draw.normal(size=2)

    def losses(vectors, output, bias):
        words = [bags.rows[a:b] for a, b in zip(bags.first[:-1], bags.first[1:])]
        out = []
        for b, w, t in zip(begin, width, target):
            mean = np.mean([vectors[words[i]].mean(axis=0) for i in bags.numbers[b : b + w]], axis=0)
            logits = mean @ output + bias
            out.append(np.log(np.exp(logits).sum()) - logits[t])
        return np.array(out)

    def slope(of, at, total):
        changed = [x.copy() for x in (vectors, output, bias)]
        changed[of][at] += 1e-6
        found = (losses(*changed) - losses(vectors, output, bias)) / 1e-6
        return found.sum() if total else found.mean()

    moved = [x.copy() for x in (vectors, output, bias)]
    squares = [np.full(toxicity.BUCKETS, 1e-6), np.full(output.shape, 1e-6), np.full(2, 1e-6)]
    toxicity.step(bags, bags.numbers, begin, width, target, *moved, squares)
    for row in np.unique(bags.rows)[:5].tolist():
        # Rates are scaled by the past, so a vector's step has the direction of its slope.
        slopes = np.array([slope(0, (row, d), True) for d in range(toxicity.DIMENSIONS)])
        expected = -toxicity.RATE * slopes / np.sqrt(1e-6 + (slopes**2).mean())
        assert np.allclose(moved[0][row] - vectors[row], expected, rtol=1e-3, atol=1e-5)
    for d in range(3):
        g = slope(1, (d, 1), False)
        assert np.isclose(moved[1][d, 1] - output[d, 1], -0.1 * g / np.sqrt(1e-6 + g**2), rtol=1e-3)

def test_odd_tables(odd, nothing, spark):
    labels = spark.createDataFrame([(6, 1), (6, 0), (7, 0), (8, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = fit(odd, labels)
    found = score_toxicity(odd, model)
    assert found.count() == odd.count() and found.columns.count("score") == 1
    empty = found.where("text IS NULL OR trim(text) = ''").select("score", "predicted").distinct().collect()
    assert all(0 <= r.score <= 1 for r in found.collect()) and [tuple(r) for r in empty if r.score == 0]
    assert score_toxicity(nothing, model).count() == 0
    # Without labels nothing is known to be toxic.
    assert drop_toxic(odd, labels.where("false")).exceptAll(odd).count() == 0
    assert drop_toxic(odd, labels.where("false")).columns == odd.columns
