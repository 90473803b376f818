import random
import re

from turnweave.llm.licenses import AGREEING, INDEXED, TEMPLATES, indexed_words, scan_licenses


def scan(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return scan_licenses(rows).orderBy("doc_id").collect()


def test_places_and_labels(spark):
    rows = scan(
        spark,
        [
            "Released UNDER the MIT-license; again: under the mit license.",
            "Licensed under the Apache License, Version 2.0.",
            "under the mit licenses",
            "Licensed: the GNU General Public License, version 3",
            "cc by nc cc by nc",
            None,
            "",
            "mit " * 3000 + "under the mit license",
        ],
    )
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) for r in rows] == [
        (10, 2, 1, 6, "mit", "mit"),
        (8, 1, 3, 3, "apache-2", "apache-2"),
        (4, 0, None, None, "", ""),
        (8, 0, None, None, "", "gpl-3"),
        (6, 2, 0, 3, "cc-by-nc", "cc-by-nc"),
        (0, 0, None, None, "", ""),
        (0, 0, None, None, "", ""),
        (3004, 1, 3000, 3000, "mit", "mit"),
    ]
    assert rows[0].score == 1.0 and 0 < rows[3].score < 1 and rows[2].score == 0


def test_indexed_words():
    for t in TEMPLATES:
        found = indexed_words(t)
        assert len({x.word for x in found}) == INDEXED and all(t.words[x.at] == x.word for x in found)
        if t.base:
            assert all(t.offset <= x.at < t.offset + len(t.key) for x in found)
    assert len(TEMPLATES) >= 30 and {x.word for x in indexed_words(TEMPLATES[0])} <= {"mit", "under", "the", "license"}


def plainly(text):
    """Every place of every key phrase, with two indexed words where the notice has them."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    out = []
    for t in TEMPLATES:
        for p in range(len(words) - len(t.key) + 1):
            at = lambda k: words[p - t.offset + k] if 0 <= p - t.offset + k < len(words) else None
            if words[p : p + len(t.key)] == t.key and sum(at(x.at) == x.word for x in indexed_words(t)) >= AGREEING:
                out.append((t.label, p, sum(at(k) == w for k, w in enumerate(t.words)) / len(t.words)))
    return sorted(out)


def test_notices_against_plain_search(spark):
    draw = random.Random(4)
    texts = []
    for t in TEMPLATES * 4:
        words = list(t.words)
        for _ in range(draw.choice([0, 0, 1, 4])):
            words[draw.randrange(len(words))] = draw.choice(["other", "license", "the", words[0]])
        if draw.random() < 0.3:
            words.insert(draw.randrange(len(words)), "extra")
        cut = draw.choice([0, 0, 3])
        texts.append(" ".join(["License", "of:", *words[cut:], "the", *draw.choice(TEMPLATES).key, draw.choice(["end", "mit license"])]))
    rows = scan(spark, texts)
    for text, row in zip(texts, rows):
        expected = plainly(text)
        assert sorted((p.label, p.begin, p.score) for p in row.places) == expected
        assert row.labels == ",".join(sorted({x[0] for x in expected}))


def test_odd_tables(odd, nothing):
    found = scan_licenses(odd)
    assert found.count() == odd.count() and found.columns.count("score") == 1
    assert found.where("score > 0").isEmpty() and scan_licenses(nothing).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
