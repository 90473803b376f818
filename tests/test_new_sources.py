"""Logs that grow, runs with deadlines, answers that are kept, tokenizers by batch, rewards over lists."""

import json
import os
import random
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from turnweave.catalog import stubs
from turnweave.functions import chat
from turnweave.operators import models, training
from turnweave.operators.ledger import ask_once
from turnweave.operators.rewards import list_reward, load_rewards, with_reward
from turnweave.operators.tokenize import IGNORED, BatchTokenizer, with_labels, with_token_ids
from turnweave.operators.transforms import transform_from_spec
from turnweave.sources.growing import GrowingLogReader, follow_logs
from turnweave.sources.jsonl import read_jsonl
from turnweave.streaming import deadlines, runs

# Workers cannot import this file.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_growing_logs(spark, tmp_path):
    logs = tmp_path / "logs" / "r1"
    logs.mkdir(parents=True)
    log, seen = logs / "run.log", []

    def trigger():
        stream = follow_logs(spark, f"{tmp_path}/logs/*/run.log*", split_bytes=7)
        runs.write_available(stream, str(tmp_path / "rows"), str(tmp_path / "progress"))
        rows = spark.read.parquet(str(tmp_path / "rows")).orderBy("log", "position").collect()
        new = [r for r in rows if (r.log, r.position) not in {(s.log, s.position) for s in seen}]
        assert len(rows) == len(seen) + len(new)
        seen[:] = rows
        return [(r.run_id, r.value) for r in new]

    log.write_text("one\ntwo is longer\nhalf")
    assert trigger() == [("r1", "one"), ("r1", "two is longer")]
    with log.open("a") as file:
        file.write(" and whole\n\nété\r\n")
    assert trigger() == [("r1", "half and whole"), ("r1", ""), ("r1", "été")]
    assert trigger() == []
    with log.open("a") as file:
        file.write("last of the old\n")
    os.rename(log, logs / "run.log.1")
    log.write_text("one\n")
    (tmp_path / "logs" / "r2").mkdir()
    (tmp_path / "logs" / "r2" / "run.log").write_text("".join(f"line {i}\n" for i in range(100)))
    found = trigger()
    assert sorted(found[:0] + [x for x in found if x[0] == "r1"]) == [("r1", "last of the old"), ("r1", "one")]
    assert [v for r, v in found if r == "r2"] == [f"line {i}" for i in range(100)]
    os.remove(logs / "run.log.1")
    assert trigger() == []


def test_a_log_emptied_in_place(tmp_path):
    (tmp_path / "r").mkdir()
    log = tmp_path / "r" / "run.log"
    log.write_text("a long first line\n")
    reader = GrowingLogReader({"path": f"{tmp_path}/*/run.log"})
    first = reader.latestOffset()
    log.write_text("new\n")
    second = reader.latestOffset()
    spans = reader.partitions(first, second)
    assert [v for s in spans for b in reader.read(s) for v in b.column("value").to_pylist()] == ["new"]


def test_deadlines(spark, tmp_path):
    before = spark.conf.get(deadlines.STORE_SETTING, None)
    with pytest.raises(ValueError):
        spark.conf.set(deadlines.STORE_SETTING, "x")
        deadlines.judged_runs(spark.readStream.format("rate").load().selectExpr("timestamp AS ts", "'a' AS run_id", "'x' AS value"), "ts", 1, "1 second")
    spark.conf.set(deadlines.STORE_SETTING, deadlines.STORE)
    saved = "INFO Model successfully saved to /m"

    def land(*lines):
        frame = spark.createDataFrame([(r, 1_700_000_000 + s, v) for r, s, v in lines], "run_id string, s long, value string")
        frame = frame.select("run_id", F.timestamp_seconds("s").alias("ts"), "value")
        frame.write.mode("append").parquet(str(tmp_path / "lines"))
        stream = spark.readStream.schema(frame.schema).parquet(str(tmp_path / "lines"))
        judged = deadlines.judged_runs(stream, "ts", 100, "10 seconds")
        runs.write_available(judged, str(tmp_path / "rows"), str(tmp_path / "progress"))
        rows = spark.read.parquet(str(tmp_path / "rows")).select("run_id", "outcome", F.unix_seconds("at").alias("s")).collect()
        return sorted((r.run_id, r.outcome, r.s - 1_700_000_000) for r in rows)

    try:
        assert land(("a", 0, "step"), ("a", 30, saved), ("a", 40, saved), ("b", 5, "step"), ("c", 6, "[WATCHER] " + saved)) == [("a", "success", 30)]
        # Repeated reports change nothing, and one that comes in time counts, whatever order lines land in.
        assert land(("a", 50, saved), ("b", 104, saved), ("d", 60, None)) == [("a", "success", 30), ("b", "success", 104)]
        # The watermark passes the deadlines of c and d; a late report of c changes nothing.
        found = land(("e", 300, "step"), ("c", 107, saved))
        assert found == [("a", "success", 30), ("b", "success", 104), ("c", "failure", 106), ("d", "failure", 160)]
        found = land(("c", 310, saved), ("f", 900, "step"))
        assert ("e", "failure", 400) in found and len([x for x in found if x[0] == "a"]) == 1
    finally:
        spark.conf.set(deadlines.STORE_SETTING, before) if before else spark.conf.unset(deadlines.STORE_SETTING)


class Counted:
    """A model that notes its calls in a file and fails at the input that has ``fail`` in it."""

    def __init__(self, notes):
        self.notes = notes

    def __call__(self):
        def answer(inputs):
            if any("fail" in (x or "") for x in inputs):
                raise RuntimeError("stopped")
            with open(self.notes, "a") as file:
                file.writelines(json.dumps(x) + "\n" for x in inputs)
            return [f"{x}!" for x in inputs]

        return answer


def test_a_killed_run_goes_on(spark, tmp_path):
    notes, folder = str(tmp_path / "notes"), str(tmp_path / "ledger")
    rows = spark.createDataFrame([(i, f"q{i % 20}") for i in range(60)] + [(99, None)], "id long, q string")
    ask = lambda q: models.generate("counted", Counted(notes), q)

    def run(frame, **more):
        return ask_once(frame, F.col("q"), "a", ask, folder, "counted", batch_rows=3, **more)

    with pytest.raises(Exception, match="stopped"):
        run(rows.unionByName(spark.createDataFrame([(100, "this one will fail")], rows.schema)))
    asked = [json.loads(x) for x in open(notes)] if os.path.exists(notes) else []
    kept = spark.read.schema("digest string").parquet(folder).count()
    assert kept > 0
    found = {r.id: r.a for r in run(rows).collect()}
    assert found == {**{i: f"q{i % 20}!" for i in range(60)}, 99: "None!"}
    after = [json.loads(x) for x in open(notes)]
    # What was written is not asked again; each distinct question is asked once.
    assert len(after) - len(asked) == 21 - kept
    assert run(rows).count() == 61 and len([1 for _ in open(notes)]) == len(after)
    # Another option is another model.
    run(rows, options={"temperature": 0}).collect()
    assert len([1 for _ in open(notes)]) == len(after) + 21


def test_batch_tokenizer(spark):
    texts = ["", None, "abc", "abcd", "é😀x" * 50]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    chunks = BatchTokenizer("chunks", stubs.chunk_tokenizer, batch_size=2)
    rows = with_token_ids(training.with_length(frame, "text", 2, chunks), "text", chunks).orderBy("id").collect()
    assert [r.n_tokens for r in rows] == [0, 0, 1, 2, 50] and [r.fits for r in rows] == [True, True, True, True, False]
    assert rows[3].token_ids == [ord("a"), ord("d")] and rows[4].token_ids[0] == ord("é")
    with pytest.raises(Exception, match="one list of tokens"):
        frame.select(BatchTokenizer("bad", lambda: lambda texts: [])(F.col("text"))).collect()


def test_tokenizer_gets_few_bytes_at_once(spark):
    def factory():
        tokenize = stubs.chunk_tokenizer()

        def bounded(texts):
            if len(texts) > 1 and sum(len(t.encode()) for t in texts) > 1 << 18:
                raise ValueError("too much at once")
            return tokenize(texts)

        return bounded

    texts = [chr(233 + n) * (n * 997 % 20_000) for n in range(150)] + ["", None, "x" * 300_000, "ab"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string").coalesce(1)
    chunks = BatchTokenizer("bounded", factory)
    found = frame.select("id", chunks(F.col("text")).alias("n"), chunks.ids(F.col("text")).alias("ids"), chunks.tokens(F.col("text")).alias("tokens"))
    for row in found.collect():
        expected = stubs.chunk_tokenizer()([texts[row.id] or ""])[0]
        assert row.n == len(expected) and row.ids == [t[0] for t in expected] and list(map(tuple, row.tokens)) == expected


def byte_tokenizer():
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    return lambda texts: [[(i, b, e) for i, (b, e) in zip(x.ids, x.offsets)] for x in loaded.encode_batch(texts, add_special_tokens=False)]


def test_labels_of_a_byte_vocabulary(spark):
    draw = random.Random(1)
    word = lambda: "".join(draw.choice("abcdé ß\n") for _ in range(draw.choice([0, 1, 5, 30])))
    chats = [[(draw.choice(["system", "user", "assistant", None]), draw.choice([word(), None])) for _ in range(draw.choice([0, 1, 4, 9]))] for _ in range(30)]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(chats)] + [(99, None)], "id long, messages array<struct<role:string,content:string>>")
    rows = {r.id: r for r in with_labels(frame, BatchTokenizer("bytes", byte_tokenizer)).collect()}
    encode = byte_tokenizer()
    for i, said in enumerate(chats):
        text, flags = "", []
        for role, content in said:
            for part, trained in ((f"<|im_start|>{role or 'user'}\n", False), (f"{content or ''}<|im_end|>", role == "assistant"), ("\n", False)):
                text += part
                flags += [trained] * len(part)
        tokens = encode([text])[0]
        assert rows[i].text == text and rows[i].token_ids == [t for t, _, _ in tokens]
        assert rows[i].labels == [t if all(flags[b:e]) else IGNORED for t, b, e in tokens]
    assert rows[99].labels == [] and rows[99].text == ""
    plain = with_labels(frame, BatchTokenizer("bytes", byte_tokenizer), template=chat.PLAIN).where("id = 0").first()
    assert len(plain.labels) == len(plain.token_ids)


def by_length(prompts, completions, **columns):
    return [len(c or "") for c in completions]


def test_rewards_over_lists(spark):
    message = "array<struct<role:string,content:string>>"
    rows = [(i, f"p{i}", [("assistant", "c" * i)], i % 2 == 0, [float(i)]) for i in range(150)]
    frame = spark.createDataFrame(rows, f"id long, prompt string, completion {message}, even boolean, more array<double>").repartition(3)

    def mixed():
        return lambda prompts, completions, even, more, **columns: [len(c[0]["content"]) + (10 if e else 0) + sum(m) for c, e, m in zip(completions, even, more)]

    found = with_reward(frame, load_rewards([list_reward("mixed", mixed, batch_size=7)], [2.0]), columns=["even", "more"]).collect()
    assert len(found) == 150 and all(r.reward == 2 * (2 * r.id + (10 if r.even else 0)) for r in found)
    # Functions with the parameters of lists are found to be so, also by their path.
    texts = frame.selectExpr("id", "prompt", "completion[0].content AS completion")
    named = load_rewards(["turnweave.catalog.stubs.length_scores", by_length], [1.0, 0.0])
    assert all(r.reward == len(r.completion) % 13 + 0.25 * (len(r.prompt) % 7) for r in with_reward(texts, named).collect())
    for bad in (lambda prompts, completions, **columns: [], lambda prompts, completions, **columns: [None] * len(prompts)):
        with pytest.raises(Exception, match="one score per completion|float"):
            with_reward(texts, load_rewards([bad])).collect()
    with pytest.raises(ValueError):
        with_reward(texts.withColumn("prompts", F.lit(1)), load_rewards([by_length]), columns=["prompts"])


def test_transform_of_single_examples(spark, tmp_path):
    rows = [{"messages": [{"role": "user", "content": "abcd"}, {"role": "assistant", "content": None}]}, {"messages": []}, {"messages": None}]
    (tmp_path / "chats.jsonl").write_text("\n".join(map(json.dumps, rows)))
    spec = {"type": "turnweave.catalog.stubs.size_transform", "path": str(tmp_path), "unit": "chars", "schema": "query string, n_messages int, size long, raw string, other double"}
    made = read_jsonl(spark, str(tmp_path / "chats.jsonl")).transform(transform_from_spec(spec))
    assert made.columns == ["query", "n_messages", "size", "raw", "other"]
    assert sorted(map(tuple, made.collect()), key=str) == sorted([("abcd", 2, 4, None, None), (None, 0, 0, None, None), (None, 0, 0, None, None)], key=str)
