import pytest


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls, empty, blank, repeated and long texts, ties, and columns whose names clash."""
    passage = " ".join(f"pass{i}" for i in range(60))
    long = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    rows = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \n\t ", None),
        (4, "one two three", "b"),
        (5, "one two three", "b"),
        (5, "one two three", "b"),
        (6, f"Start {passage} end of the first.", "c"),
        (7, f"Another {passage} and more words here.", "c"),
        (None, f"Without id {passage}", None),
        (None, None, None),
        (8, long, "d"),
        (9, "é" * 40 + " straße\u00a0x \u2028 y 😀", "d"),
    ]
    rows = [(*r, 0, "x", 0.5, "k") for r in rows]
    names = "doc_id long, text string, source string, n_words int, Score string, longest double, _row string"
    return spark.createDataFrame(rows, names).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
