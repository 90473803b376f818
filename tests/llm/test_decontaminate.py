import random
import re

import pytest
from pyspark.sql import functions as F

from turnweave.llm import decontaminate as module
from turnweave.llm.decontaminate import contamination, decontaminate, is_contaminated

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"


def words(text):
    return re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plainly(docs, items, window):
    """Hit words and items of each text, by trying every window everywhere."""
    tries = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            tries.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(t) for t in tries}:
            for i in range(len(w) - size + 1):
                if (key := tuple(w[i : i + size])) in tries:
                    hit |= set(range(i, i + size))
                    found |= {x for x in tries[key] if x is not None}
        out.append((len(w), len(hit), sorted(map(str, found))))
    return out


@pytest.mark.parametrize("block", [12, 100_000])
def test_against_every_window(spark, block):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    items = [(i, text(draw.choice([0, 1, 2, 3, 5, 9, 30]))) for i in range(12)] + [(3, "a b"), (None, "c c c c"), (20, None)]
    docs = [text(draw.choice([0, 1, 4, 40])) for _ in range(60)] + [None, "", "a, B. c"]
    frame = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3)
    known = spark.createDataFrame(items, "item_id long, text string")
    found = contamination(frame, known, window=4, block_words=block).orderBy("doc_id").collect()
    assert [(r.n_words, r.n_hit, r.item_ids) for r in found] == plainly(docs, items, 4)
    for row in found:
        assert row.n_hit == sum(e - b for b, e in zip(row.spans[::2], row.spans[1::2]))


def test_spans_go_and_clean_documents_stay(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi"
    docs = [
        (1, f"Before, {item.title()}! After."),
        (2, item),
        (3, f"{item} " + "other words " * 200),
        (4, "clean text"),
        (5, None),
        (6, ""),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = {r.doc_id: r.text for r in decontaminate(frame, items).collect()}
    assert kept == {1: "Before, ! After.", 3: docs[2][1], 4: "clean text", 5: None, 6: ""}
    assert decontaminate(frame, items).columns == frame.columns


def test_odd_tables(odd, nothing, spark):
    items = spark.createDataFrame([(1, "one two three"), (2, None)], "item_id long, text string")
    found = contamination(odd, items)
    assert {"n_words", "n_hit", "source", "Score", "_row"} <= set(found.columns)
    assert found.where(is_contaminated()).select("doc_id").collect() == [(4,), (5,), (5,)] or {
        r.doc_id for r in found.where(is_contaminated()).collect()
    } == {4, 5}
    assert found.count() == odd.count() and contamination(nothing, items).count() == 0
    assert contamination(odd, items.where("false")).agg(F.sum("n_hit")).first()[0] == 0
    assert decontaminate(odd, items).count() == odd.count() - 3
    assert decontaminate(nothing, items).columns == odd.columns


def test_blocks_come_one_at_a_time(spark, monkeypatch):
    log, blocks, hits = [], module._blocks, module._hits

    def counted(*args):
        for block in blocks(*args):
            log.append("block")
            yield block

    monkeypatch.setattr(module, "_blocks", counted)
    monkeypatch.setattr(module, "_hits", lambda *args: log.append("pass") or hits(*args))
    items = spark.createDataFrame([(i, " ".join(f"i{i}w{k}" for k in range(14))) for i in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x i0w0 " + " ".join(f"i3w{k}" for k in range(14)))], "doc_id long, text string")
    found = contamination(docs, items, block_words=14).first()
    assert log == ["block", "block", "pass", "block", "pass", "block", "pass", "pass"]
    assert found.n_hit == 14 and found.item_ids == ["3"]
