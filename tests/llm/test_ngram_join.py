import random
import re

import pytest
from pyspark.sql import functions as F

from turnweave.llm import ngram_join
from turnweave.llm.ngram_join import components, one_of_each_group, similar_groups


def shingles(text, n=5):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
    return {tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set()


def plainly(docs):
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    least = {}
    for i, (d, _) in enumerate(docs):
        least[root(i)] = min(d, least.get(root(i), d))
    return {d: (len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(docs)}


def copies(draw, base, count, edits):
    for _ in range(count):
        w = list(base)
        for _ in range(draw.randint(0, edits)):
            w[draw.randrange(len(w))] = f"e{draw.randrange(10_000)}"
        yield " ".join(w)


@pytest.mark.parametrize("long_list, block", [(32, 1024), (3, 4)])
def test_against_all_pairs(spark, monkeypatch, long_list, block):
    monkeypatch.setattr(ngram_join, "LONG_LIST", long_list)
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", block)
    draw = random.Random(5)
    texts = []
    for size in (30, 60, 150, 400):
        base = [f"w{draw.randrange(300)}" for _ in range(size)]
        texts += copies(draw, base, 25, max(2, size // 25))
    texts += ["a b", "A B", "a b c", "", None, " ", "a b c d e f", "a b c d e F"]
    order = list(range(len(texts)))
    draw.shuffle(order)
    docs = list(zip(order, texts))
    found = similar_groups(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plainly(docs)


def test_frequent_shingles_go_their_own_way(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_COUNT", 3)
    draw = random.Random(6)
    base = [f"w{i}" for i in range(80)]
    docs = list(enumerate(copies(draw, base, 30, 4)))
    found = similar_groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plainly(docs)


def test_large_component_of_a_long_list_is_dealt_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "LIST_BLOCK", 4)

    def dealt(inner, outer):
        rows = [(7, k, 0 if k < inner else k, 0, inner, inner + outer) for k in range(inner + outer)]
        frame = spark.createDataFrame(rows, "gram long, key long, label long, major long, major_size long, size long")
        groups = {}
        for r in ngram_join.dealt_to_blocks(frame).collect():
            groups.setdefault((r.low, r.high), []).append((r.key, r.own))
        met = set()
        for (low, high), found in groups.items():
            met |= {(min(a, b), max(a, b)) for a, x in found for b, y in found if a != b and (low == high or x != y)}
        assert met == {(a, b) for b in range(inner, inner + outer) for a in range(b)}
        return sum(map(len, groups.values()))

    # Each of the component once, the one outside with each of the ten blocks and its own.
    assert dealt(40, 1) == 40 + 11
    dealt(9, 13)


def test_texts_of_classes_whose_rows_share_an_id(spark):
    rows = [(i, f"a{x} b{x} c{x} d{x} e{x}") for i in (None, 3) for x in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = ngram_join.prefixes(docs, ngram_join.shingle_counts(docs, "text", 5), "doc_id", "text", 5, ngram_join.THRESHOLD)
    verifier = ngram_join.Verifier(docs, table, "doc_id", "text", 5, ngram_join.THRESHOLD)
    keys = table.select("key")
    assert verifier.texts(keys).count() == 12
    assert verifier.sets(keys).count() == 12


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 101), (7, 7)]
    found = components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {(r.key, r.label) for r in found} == {(i, 0) for i in range(1, 31)} | {(101, 100)}


def test_one_document_of_each_group(odd, nothing):
    kept = one_of_each_group(odd)
    assert kept.columns == odd.columns
    ids = [r.doc_id for r in kept.collect()]
    # Copies of 4 and the near copy of 6 go; rows without words or id stay.
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 8, 9] and ids.count(None) == 2
    assert one_of_each_group(nothing).count() == 0
    groups = similar_groups(odd).where("doc_id = 5").collect()
    assert [r.component_id for r in groups] == [4, 4]


def test_repeated_rows_of_the_id_that_stays(spark):
    rows = spark.createDataFrame([(1, "a b c"), (1, "a b c"), (2, "a b c"), (3, "z")], "doc_id long, text string")
    assert sorted(r.doc_id for r in one_of_each_group(rows).collect()) == [1, 3]


def test_other_texts_of_an_id_stay(spark):
    def kept(rows, **more):
        frame = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("_dropped", "_id", "_mark", "stays", "label", "c0"):
            frame = frame.selectExpr("*", f"'x' AS `{name}`")
        found = one_of_each_group(frame)
        assert found.columns == frame.columns
        return sorted((r.doc_id, r.text) for r in found.collect())

    a, u = "a b c d e f", "u v w x y z"
    assert kept([(3, a), (5, a), (5, u)]) == [(3, a), (5, u)]
    assert kept([(1, a), (1, u)]) == [(1, a), (1, u)]
    assert kept([(1, a), (1, a), (1, u), (2, u), (0, "q")]) == [(0, "q"), (1, a), (1, u)]


def test_ids_are_whole_numbers(spark):
    with pytest.raises(TypeError):
        similar_groups(spark.createDataFrame([("x", "a b c")], "doc_id string, text string"))
