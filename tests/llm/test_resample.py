"""Importance resampling against plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from turnweave.llm.resample import resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, longest):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, longest, buckets, percent, least, seed):
    slot = lambda g: zlib.crc32(g.encode()) % buckets
    source = Counter(slot(g) for _, t in docs for g in grams(t, longest)[1])
    wanted = Counter(slot(g) for t in target for g in grams(t, longest)[1])
    s, t = sum(source.values()), sum(wanted.values())
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)]
    out, drawn = [], []
    for doc, text in docs:
        words, found = grams(text, longest)
        weight = sum(gain[slot(g)] for g in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc, len(words), len(found), weight, score))
        if len(words) >= least:
            drawn.append((-score, doc if doc is not None else -math.inf, len(out) - 1))
    ranks = {i: k + 1 for k, (_, _, i) in enumerate(sorted(drawn)[: percent * len(drawn) // 100])}
    return [(*row, ranks.get(i)) for i, row in enumerate(out)]


def sort(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


@pytest.mark.parametrize("longest,buckets", [(1, 10_000), (3, 97), (2, 1)])
def test_against_plain_python(spark, longest, buckets):
    draw = random.Random(longest)
    words = ["Ab", "ab", "été", "ß", "x9", "😀", "word", "other", "zz"]
    text = lambda: "".join(draw.choice(words) + draw.choice([" ", "-", ", ", "\n", "\x00"]) for _ in range(draw.choice([0, 1, 3, 25, 60])))
    docs = [(i, text()) for i in range(400)] + [(500, None), (501, ""), (502, " .. "), (7, "word " * 30)]
    target = [text() for _ in range(30)] + [None]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = resample(frame, spark.createDataFrame([(t,) for t in target], "text string"), longest=longest, buckets=buckets, percent=15, least_words=10, seed=3)
    assert sort(map(tuple, found.collect())) == sort(plain(docs, target, longest, buckets, 15, 10, 3))


def test_ties_take_the_smaller_id_and_shares_round_down(spark):
    docs = spark.range(59).selectExpr("id AS doc_id", "repeat('same words ', 20) AS text")
    found = resample(docs, docs.where("false")).collect()
    assert sorted(r["rank"] for r in found if r["rank"]) == [1, 2, 3, 4, 5]
    order = sorted(found, key=lambda r: (-r.score, r.doc_id))
    assert [r["rank"] for r in order[:5]] == [1, 2, 3, 4, 5]


def test_odd_tables(spark, odd, nothing):
    rows = resample(odd, nothing, percent=100, least_words=1).collect()
    assert len(rows) == odd.count()
    assert all(r["rank"] is None and r.weight == 0 for r in rows if r.n_words == 0)
    assert sorted(r["rank"] for r in rows if r.n_words) == list(range(1, sum(r.n_words > 0 for r in rows) + 1))
    assert resample(nothing, odd).count() == 0 and resample(odd, odd).columns[0] == "doc_id"
    strings = odd.selectExpr("CAST(doc_id AS STRING) AS name", "text AS body", "score AS `rank`")
    assert resample(strings, odd.withColumnRenamed("text", "body"), "name", "body").count() == odd.count()
