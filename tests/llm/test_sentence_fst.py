import itertools
import math
import random
from array import array

import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnweave.llm.sentence_fst import BYTE_WEIGHT, MODEL, Transducer, decode_pieces, encode_batch, encode_pieces, load

TEXTS = st.lists(st.none() | st.text(st.sampled_from("ab A.é▁\n\t 漢😀\x00"), max_size=20), max_size=6)


@settings(max_examples=100, deadline=None)
@given(TEXTS)
def test_round_trip_and_stretches(texts):
    transducer = load()
    numbers, counts = encode_batch(pa.array(texts, pa.string()), transducer)
    at = 0
    for text, count in zip(texts, counts.tolist()):
        pieces = numbers[at : at + count].tolist()
        at += count
        assert transducer.decode(pieces) == (text or "")
        # Encoding by stretches is the shortest path of the whole text.
        assert pieces == (transducer.shortest(" " + text) if text else [])


def test_least_weight_among_all_paths():
    pieces = [(0, "a", 3.0), (1, "b", 3.5), (2, "ab", 5.0), (3, "ba", 4.0), (4, "aba", 9.0), (5, " a", 4.5), (6, " ", 2.0)]
    transducer = Transducer(pieces, {value: 100 + value for value in range(256)})
    weights = {p: w for _, p, w in pieces}

    def least(text):
        if not text:
            return 0.0
        heads = [weights[p] + least(text[len(p) :]) for p in weights if text.startswith(p)]
        return min([*heads, BYTE_WEIGHT * len(text[0].encode()) + least(text[1:])])

    cost = {n: w for n, _, w in pieces}
    for size in range(1, 7):
        for letters in itertools.product("ab c", repeat=size):
            text = "".join(letters)
            path = transducer.shortest(text)
            assert math.isclose(sum(cost.get(n, BYTE_WEIGHT) for n in path), least(text))
            assert b"".join(transducer.spelled[n] for n in path).decode() == text


def test_decodes_the_library_s_own_encoding():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    text = "Plain words, and  spaces; été\n"
    assert load().decode(library.encode(text)) == text
    numbers, _ = encode_batch(pa.array([text]), load())
    assert library.decode(numbers.tolist()) == text


def test_odd_tables(odd, nothing):
    found = decode_pieces(encode_pieces(odd))
    assert found.where(F.col("decoded") == F.coalesce("text", F.lit(""))).count() == odd.count()
    assert found.where("n_pieces = 0").count() == 3
    assert encode_pieces(nothing).count() == 0
    unknown = decode_pieces(odd.select(F.lit(None).cast("array<int>").alias("piece_ids")))
    assert unknown.where("decoded IS NULL").count() == odd.count()


def test_a_model_without_byte_pieces_is_refused(monkeypatch):
    class Bare:
        def __init__(self, model_file):
            pass

        vocab_size = staticmethod(lambda: 1)
        id_to_piece = staticmethod(lambda n: "a")
        is_byte = is_control = is_unknown = is_unused = staticmethod(lambda n: False)

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Bare)
    with pytest.raises(ValueError, match="byte"):
        load("elsewhere")


def test_many_stretches_at_once():
    """The same paths as one stretch at a time, ties and bytes included."""
    transducer, draw = load(), random.Random(6)
    letters = "aeiou étrs\n.#😀ß中\x00  "
    stretches = ["".join(draw.choice(letters) for _ in range(draw.choice([0, 1, 2, 9, 30]))).encode() for _ in range(2000)]
    expected = [array("i", transducer.shortest(x.decode())).tobytes() for x in stretches]
    assert transducer.shortest_of(stretches) == expected
    assert transducer.shortest_of([]) == [] and transducer.shortest_of([b"", b""]) == [b"", b""]
    long = ["".join(draw.choice(letters) for _ in range(3000)).encode(), *stretches, *stretches[:50]]
    assert transducer.encode_all(long)[1:] == [*expected, *expected[:50]]
    transducer.forget()
