"""Hashes of words and windows against plain Python."""

import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from turnweave.llm.words import ALPHANUMERIC, EXACT, FOLDED, slices, words_of

PATTERNS = {
    "ALPHANUMERIC": (ALPHANUMERIC, "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", True),
    "EXACT": (EXACT, "[^\\x20\\x09-\\x0D]+", False),
    "FOLDED": (FOLDED, "[^\\x20\\x09-\\x0D]+", True),
}
TEXTS = st.lists(st.none() | st.text(st.sampled_from("aAbZ19 \n\t.-_é😀\x00"), max_size=30), max_size=8)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.sampled_from(sorted(PATTERNS)), st.integers(1, 4))
def test_words_and_windows(texts, name, n):
    kind, pattern, folded = PATTERNS[name]
    found = words_of(pa.array(texts, pa.string()), kind)
    expected = [re.findall(pattern, lower(t) if folded else t) for t in (x or "" for x in texts)]
    assert found.counts.tolist() == [len(w) for w in expected]
    flat = [w for ws in expected for w in ws]
    spelled = [found.text(i).decode() for i in range(len(flat))]
    assert [lower(s) if folded else s for s in spelled] == flat
    same = {}
    for word, value in zip(flat, found.hashes.tolist()):
        assert same.setdefault(word, value) == value
    assert len(set(same.values())) == len(same)
    places, hashes = found.windows(n)
    windows = [tuple(w[i : i + n]) for w in expected for i in range(len(w) - n + 1)]
    begins = [int(f) + i for f, w in zip(found.first, expected) for i in range(len(w) - n + 1)]
    assert places.tolist() == begins
    same = {}
    for window, value in zip(windows, hashes.tolist()):
        assert same.setdefault(window, value) == value
    assert len(set(same.values())) == len(same)


def test_slices_keep_rows():
    texts = ["a" * 10, None, "b" * 100, "", "c"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["t"])
    pieces = list(slices(iter([batch]), "t", 20))
    assert [x for p in pieces for x in p.column("t").to_pylist()] == texts
    assert max(p.num_rows for p in pieces) < 5
