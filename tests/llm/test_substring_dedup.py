import random

import pytest

from turnweave.llm import substring_dedup
from turnweave.llm.substring_dedup import levels_of, remove_repeats


def plainly(docs, window):
    split = [(t or "").split() for t in docs]
    seen = {}
    for d, w in enumerate(split):
        for i in range(len(w) - window + 1):
            seen.setdefault(tuple(w[i : i + window]), []).append((d, i))
    gone = [set() for _ in docs]
    for places in seen.values():
        if len(places) > 1:
            for d, i in places:
                gone[d] |= set(range(i, i + window))
    return [(len(w), len(g), " ".join(x for i, x in enumerate(w) if i not in g)) for w, g in zip(split, gone)]


def test_levels():
    assert levels_of(35) == [9, 18, 35]
    assert levels_of(1) == [1]


@pytest.mark.parametrize("window", [1, 2, 5, 12])
@pytest.mark.parametrize("chunk", [64, 4 << 20])
def test_against_every_window(spark, monkeypatch, window, chunk):
    monkeypatch.setattr(substring_dedup, "CHUNK_BYTES", chunk)
    draw = random.Random(window)
    text = lambda n: " ".join(draw.choice(["a", "b", "c", "longer"]) for _ in range(n))
    docs = [text(draw.choice([0, 1, 7, 30])) for _ in range(40)] + [None, "", "a\t b\n\na  b", "x" * 50]
    docs += [docs[3], docs[3]]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    found = remove_repeats(frame, window=window).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_removed, r.kept) for r in found] == plainly(docs, window)


def test_odd_tables(odd, nothing):
    found = remove_repeats(odd).collect()
    assert len(found) == odd.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert by_id[6].kept == "Start end of the first." and by_id[7].kept == "Another and more words here."
    assert by_id[8].n_removed == 0 and by_id[1].n_words == by_id[2].n_words == by_id[3].n_words == 0
    assert {(r.n_words, r.n_removed) for r in found if r.doc_id is None} == {(62, 60), (0, 0)}
    assert remove_repeats(nothing).count() == 0
