"""Reading judge replies: exact cases, and the means built on them."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnweave.functions.judging import read_replies, read_replies_by_rubric
from turnweave.operators.summary import (
    category_means_by_rubric,
    overall_mean_by_rubric,
    summarize,
)
from turnweave.sources.rubrics import BUILT_IN, Category, Rubric, read_rubrics, rubric_table

RUBRIC = Rubric((Category("h", 1.0, "?"), Category("g o.o$d", 3, "?")), "Judge.")


def read(spark, replies, rubric=RUBRIC):
    frame = spark.createDataFrame(list(enumerate(replies)), "id int, raw string")
    return read_replies(frame, rubric).orderBy("id").collect()


def scored(value: str) -> str:
    return f'{{"scores": {{"h": {value}}}}}'


CASES = {
    scored("4"): 4.0,
    scored("4.5"): 4.5,
    scored("99"): 5.0,
    scored("-3"): 0.0,
    scored("-0.0"): 0.0,
    scored('"4"'): None,
    scored('"NaN"'): None,
    scored("true"): 1.0,
    scored("false"): 0.0,
    scored("null"): None,
    scored("[4]"): None,
    scored('{"a": 1}'): None,
    scored("1e400"): 5.0,
    scored("1" * 50): 5.0,
    scored("2.5e0"): 2.5,
    scored("04"): None,
    scored("NaN"): None,
    scored("Infinity"): None,
    '{"scores": 4}': None,
    '{"scores": [1, 2]}': None,
    '{"scores": null}': None,
    '{"other": {"h": 4}}': None,
    "{}": None,
    "": None,
    "no json": None,
    '{"scores": {"h": 4}} x {"a": 1}': None,
    '{"scores": {"h": 4}}, {"scores": {"h": 3}}': None,
    '{"a": 1}], [{"b": 2}': None,
    'ok: {"scores": {"h": 4}} done.': 4.0,
    '{"scores": {"h": 4}, "scores": {"h": 2}}': 2.0,
    '{"scores": {"h": 4, "h": 3}}': 3.0,
    "{'scores': {'h': 4}}": None,
    '{"scores": {"h": 4,}}': None,
    '{"scores": {"h": 4}, "reasons": {"h": "a\nb"}}': None,
    '{"scores": {"h": 4}': None,
    '```json\n{"scores":\n{"h": 3}}\n```': 3.0,
}


def test_score_cases(spark):
    found = read(spark, CASES)
    for row, (raw, expected) in zip(found, CASES.items()):
        assert row.scores["h"] == expected, raw
        assert set(row.scores) == set(row.reasons) == {"h", "g o.o$d"}
        assert str(row.scores["h"]) != "-0.0"
    assert read(spark, [None])[0].scores == {"h": None, "g o.o$d": None}


def test_reasons_and_odd_keys(spark):
    body = {"scores": {"g o.o$d": 2}, "reasons": {"h": " 　why\n", "g o.o$d": 4, "x": "no"}}
    row = read(spark, [json.dumps(body)])[0]
    assert row.reasons == {"h": "why", "g o.o$d": ""}
    assert row.scores == {"h": None, "g o.o$d": 2.0}
    # The missing score counts 0 with its full weight.
    assert row.overall == (0 * 1 + 2 * 3) / 4


def plain_reading(raw: str):
    """The rules again, without Spark, for texts without bare NaN or Infinity."""
    start, end = raw.find("{"), raw.rfind("}")
    try:
        body = json.loads(raw[start : end + 1]) if 0 <= start < end else {}
    except ValueError:
        body = {}
    scores = body.get("scores") if isinstance(body, dict) else None
    value = scores.get("h") if isinstance(scores, dict) else None
    return None if not isinstance(value, (int, float)) else max(0.0, min(5.0, float(value)))


JSON = st.recursive(
    st.none() | st.booleans() | st.integers(-(10**9), 10**9) | st.floats(-1e6, 1e6) | st.text(max_size=5),
    lambda inner: st.lists(inner, max_size=3)
    | st.dictionaries(st.sampled_from(["h", "scores", "x"]), inner, max_size=3),
    max_leaves=6,
)
REPLIES = st.lists(
    st.tuples(
        st.text(max_size=4),
        st.one_of(JSON, JSON.map(lambda v: {"scores": {"h": v}}), JSON.map(lambda v: {"scores": v})),
        st.text(max_size=4),
        st.integers(0, 3),
    ),
    min_size=1,
    max_size=60,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(REPLIES)
def test_any_reply(spark, parts):
    replies = []
    for before, body, after, cut in parts:
        text = json.dumps(body, ensure_ascii=False)
        replies.append(before + (text[: len(text) - cut]) + after)
    replies = [r.encode("utf-8", "ignore").decode() for r in replies]
    for raw, row in zip(replies, read(spark, replies)):
        assert row.scores["h"] == pytest.approx(plain_reading(raw)), raw


def test_summary_of_nothing(spark):
    row = summarize(read_replies(spark.createDataFrame([], "raw string"), BUILT_IN), BUILT_IN).first()
    assert row.n == 0 and row.overall_mean == 0.0
    assert (row.next_algorithm, row.decision_reason) == ("SFT", "Low format_compliance")


def test_null_rules_differ_by_level(spark):
    frame = spark.createDataFrame([(scored("4"),), (scored("null"),), ("x",)], "raw string")
    results = read_replies(frame, RUBRIC)
    row = summarize(results, RUBRIC).first()
    assert row.category_means == {"h": 4.0, "g o.o$d": 0.0}
    assert row.overall_mean == 4.0 / 4
    assert (row.n, row.parse_failed) == (3, 2)
    per_row = results.agg(F.avg("overall")).first()[0]
    assert per_row == pytest.approx(1 / 3)


def test_means_by_rubric_agree_with_one_rubric(spark):
    frame = spark.createDataFrame([(scored("4"),), (scored("1"),), ("x",)], "raw string")
    results = read_replies(frame, RUBRIC).withColumn("rubric_id", F.lit("r"))
    means = category_means_by_rubric(results, rubric_table(spark, {"r": RUBRIC}), ("rubric_id",))
    assert {r.key: r["mean"] for r in means.collect()} == {"h": 2.5, "g o.o$d": 0.0}
    overall = overall_mean_by_rubric(means, ("rubric_id",)).first().overall_mean
    assert overall == summarize(results, RUBRIC).first().overall_mean


def test_local_clamp(spark):
    rubric = Rubric((Category("h", 2, "?"),), "Judge.", 1, 3)
    assert [r.overall for r in read(spark, [scored("9"), scored("-9"), "x"], rubric)] == [3.0, 1.0, 0.0]
    weightless = Rubric((Category("h", 0, "?"),), "Judge.")
    assert read(spark, [scored("4")], weightless)[0].overall == 0.0


def test_a_rubric_per_row(spark):
    ten = Rubric((Category("h", 1, "?"), Category("deep", 3, "?")), "Judge.", 1, 10)
    rows = [("five", scored("9")), ("ten", scored("9")), ("ten", '{"scores": {"deep": 0, "h": "x"}, "reasons": {"deep": " so "}}'), ("ten", "none")]
    frame = spark.createDataFrame(rows, "rubric_id string, raw string")
    table = rubric_table(spark, {"five": RUBRIC, "ten": ten})
    found = {r.raw + r.rubric_id: r for r in read_replies_by_rubric(frame, table).collect()}
    assert found[rows[0][1] + "five"].scores == {"h": 5.0, "g o.o$d": None}
    assert found[rows[1][1] + "ten"].scores == {"h": 9.0, "deep": None}
    row = found[rows[2][1] + "ten"]
    assert (row.scores, row.reasons, row.overall) == ({"h": None, "deep": 1.0}, {"h": "", "deep": "so"}, 3 / 4)
    assert found["noneten"].scores == {"h": None, "deep": None} and found["noneten"].overall == 0.0


def test_per_row_reading_agrees_with_one_rubric(spark):
    frame = spark.createDataFrame([(raw,) for raw in CASES], "raw string").withColumn("rubric_id", F.lit("r"))
    single = {r.raw: r for r in read_replies(frame, RUBRIC).collect()}
    for row in read_replies_by_rubric(frame, rubric_table(spark, {"r": RUBRIC})).collect():
        assert (row.scores, row.reasons) == (single[row.raw].scores, single[row.raw].reasons), row.raw


def test_rubric_files(spark, tmp_path):
    (tmp_path / "mine.json").write_text(RUBRIC.to_json())
    row = read_rubrics(spark, str(tmp_path)).first()
    assert (row.rubric_id, row.scale_min, row.scale_max) == ("mine", 0.0, 5.0)
    assert [(c.key, c.weight) for c in row.categories] == [("h", 1.0), ("g o.o$d", 3.0)]
    assert Rubric.from_json(RUBRIC.to_json()) == RUBRIC
