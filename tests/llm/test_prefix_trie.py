"""The prefix trie against plain Python."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from turnweave.llm import prefix_trie as module
from turnweave.llm.prefix_trie import prefix_trie


def plain(rows, family=100, most=6):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members = defaultdict(list)
    built = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % most
        begin = conv - (abs(conv) % family) * (1 if conv >= 0 else -1)
        built[conv] = tuple(own.get(begin, [])[:h] + turns[h:])
        for d in range(len(built[conv]) + 1):
            members[built[conv][:d]].append(conv)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    total = {}
    for node in sorted(members, key=len, reverse=True):
        below = [total[k] for k in kids[node]]
        saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        total[node] = (sum(x for x, _ in below) or 1, saved + sum(x for _, x in below))
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(kids[node]), *total[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int").repartition(5)
    return sorted(map(tuple, prefix_trie(frame, **options).collect()), key=str)


@pytest.mark.parametrize("height,span", [(16, 64), (3, 2), (1, 1)])
def test_against_plain_python(spark, monkeypatch, height, span):
    monkeypatch.setattr(module, "SPAN", span)
    monkeypatch.setattr(module, "SPELLED", 3)
    draw = random.Random(height)
    rows = []
    for conv in draw.sample(range(-150, 450), 120):
        for turn in range(draw.choice([1, 2, 3, 5, 7, 9])):
            rows.append((conv, turn if turn else None, draw.choice(["user", "assistant", None]), draw.choice(["", "a", "b😀", None])))
    rows += [(500, t, "user", "same") for t in range(12)] + [(c, t, "user", "same") for c in range(501, 530) for t in range(3)]
    rows += [(None, 0, "user", "nobody")]
    assert found(spark, rows, height=height) == plain(rows)


def test_one_conversation_all_copies_and_no_rows(spark):
    assert found(spark, [(3, 0, "user", "x" * 5000)]) == plain([(3, 0, "user", "x" * 5000)])
    copies = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(2)]
    assert found(spark, copies) == plain(copies)
    assert found(spark, []) == []
    assert found(spark, [(None, 1, None, None)]) == []


def test_turns_of_one_number_and_repeated_rows(spark):
    rows = [(7, None, "b", "x"), (7, None, "a", "y"), (7, 1, "u", "z"), (7, 1, "u", "z"), (9, None, "a", "y")]
    assert found(spark, rows) == plain(rows)


def test_a_long_conversation(spark):
    rows = [(c, t, "user", f"{t % 7}") for c in (100, 101) for t in range(200)]
    assert found(spark, rows) == plain(rows)
