"""Single files, and evaluations that go on."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from turnweave.catalog import stubs
from turnweave.plans.evaluation import evaluate
from turnweave.sources import single_file
from turnweave.sources.single_file import write_one_file

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fails_late(row):
    if row["id"] == 300:
        raise RuntimeError("stopped")
    return json.dumps(row)


def test_lines_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(single_file, "PIECE_BYTES", 100)
    rows = [(i, f"é \u2028 \\ \" {i}\n" * (i % 7), {"k": 0.1 * i if i % 3 else None}, [i, None], ("x", i)) for i in range(400)]
    frame = spark.createDataFrame(rows, "id long, text string, scores map<string,double>, list array<long>, pair struct<a:string,b:long>")
    path = tmp_path / "deep" / "out.jsonl"
    size = write_one_file(frame.repartition(7), str(path), "id")
    expected = "".join(json.dumps({"id": i, "text": t, "scores": m, "list": x, "pair": {"a": p[0], "b": p[1]}}, ensure_ascii=False) + "\n" for i, t, m, x, p in rows)
    assert path.read_bytes() == expected.encode() and size == len(expected.encode())
    assert write_one_file(frame.where("false"), str(path), "id") == 0 and path.read_bytes() == b""
    with pytest.raises(Exception, match="stopped"):
        write_one_file(frame.select("id"), str(tmp_path / "other"), "id", render=fails_late)
    assert os.listdir(tmp_path) == ["deep"] and os.listdir(tmp_path / "deep") == ["out.jsonl"]


def test_evaluation_with_a_ledger(spark, tmp_path):
    rows = [(i, [("user", f"q{i % 5}"), ("assistant", "a")]) for i in range(20)]
    frame = spark.createDataFrame(rows, "id long, messages array<struct<role:string,content:string>>")
    folder, ledger = str(tmp_path / "out"), str(tmp_path / "ledger")
    models = [("g", stubs.generator), ("j", stubs.judge)]
    first = evaluate(frame.where("id < 3"), *models, ledger=ledger)
    # Another function under the same name shows which answers were kept.
    predictions, results, summary = evaluate(frame, ("g", stubs.late_generator), models[1], folder, ledger=ledger, single_files=True)
    found = {r.id: r.completion for r in predictions.collect()}
    assert all(found[i].startswith("late: ") == (i % 5 >= 3) for i in range(20)) and first[0].count() == 3
    lines = [json.loads(x) for x in open(f"{folder}/predictions.jsonl")]
    assert [x["id"] for x in lines] == list(range(20)) and [x["completion"] for x in lines] == [found[i] for i in range(20)]
    judged = [json.loads(x) for x in open(f"{folder}/judge_results.jsonl")]
    assert [x["id"] for x in judged] == list(range(20)) and set(judged[0]) == {"scores", "reasons", "id", "overall"}
    text = open(f"{folder}/summary.json").read()
    whole = json.loads(text)
    assert whole["n"] == 20 and text == json.dumps(whole, indent=2) and list(whole)[0] == "category_means"
    plain = evaluate(frame, *models)[2].first()
    again = evaluate(frame, *models, ledger=str(tmp_path / "fresh"))[2].first()
    assert plain == again and results.where(F.col("overall").isNull()).count() == 0
