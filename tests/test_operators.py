"""Ids, packing, advantages, rewards, models, transforms, preferences."""

import random
from collections import Counter, defaultdict
from functools import partial
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnweave.catalog import stubs
from turnweave.operators import ids, models, rewards, training
from turnweave.operators.groups import group_advantage
from turnweave.functions.judging import read_replies
from turnweave.operators.preferences import PreferenceFormat, incomplete, map_preferences
from turnweave.operators.transforms import messages_to_query, transform_from_spec
from turnweave.plans import stages
from turnweave.plans.evaluation import evaluate, evaluate_file
from turnweave.plans.rollouts import rollouts_from_settings
from turnweave.session import configure
from turnweave.sources import jsonl
from turnweave.sources.rubrics import BUILT_IN

# ids -------------------------------------------------------------------------------------


def test_dense_ids_follow_key_order(spark):
    keys = [(i % 3, i) for i in range(500)]
    random.Random(1).shuffle(keys)
    frame = spark.createDataFrame(keys, "a long, b long").repartition(7)
    found = ids.dense_ids(frame, "a", "b").collect()
    assert {(r.a, r.b): r.id for r in found} == {k: i for i, k in enumerate(sorted(keys))}


def test_file_order_ids(spark, tmp_path):
    wanted = []
    for name, size in (("a.jsonl", 3), ("b.jsonl", 4000), ("c.jsonl", 2)):
        lines = [f'{{"source_file": "{name}{i}"}}' for i in range(size)]
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        wanted += [f"{name}{i}" for i in range(size)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")  # several splits per file
    try:
        found = ids.file_order_ids(jsonl.read_jsonl(spark, str(tmp_path)))
        assert [r.source_file for r in found.orderBy("id").collect()] == wanted
        assert [r.id for r in found.orderBy("id").collect()] == list(range(len(wanted)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dense_ids_of_nothing(spark):
    assert ids.dense_ids(spark.range(0), "id").count() == 0


def test_limits(spark):
    frame = spark.range(10).repartition(4)
    assert [r.id for r in ids.first_rows(frame, 3, "id").collect()] == [0, 1, 2]
    assert ids.first_rows(frame, 0, "id").count() == 0
    assert ids.first_rows(frame, None, "id").count() == 10


def test_batches_are_short_at_the_end_only(spark):
    sizes = Counter(tuple(r)[1:] for r in ids.with_batches(spark.range(70), 32, 16).collect())
    assert sizes == {(0, 0): 16, (0, 1): 16, (1, 0): 16, (1, 1): 16, (2, 0): 6}
    with pytest.raises(ValueError):
        ids.with_batches(spark.range(1), 64, 48)


def test_steps(spark):
    assert ids.steps_per_epoch(spark.range(33), 2, 8, 1).first().steps == 3
    assert ids.steps_per_epoch(spark.range(32), 2, 8, 2).first().steps == 1
    assert ids.steps_per_epoch(spark.range(0), 2).first().steps == 0


def test_zip_drops_rows_without_partner(spark):
    left = spark.createDataFrame([(0, "a"), (1, "b")], "id long, query string")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "id long, completion string")
    assert [tuple(r) for r in ids.zip_by_id(left, right).collect()] == [(1, "b", "x")]


# training rows ---------------------------------------------------------------------------


def test_split_is_stable_and_complete(spark):
    frame = spark.range(5000)
    one = {r.id: r.split for r in training.with_split(frame, "id").collect()}
    two = {r.id: r.split for r in training.with_split(frame.repartition(13), "id").collect()}
    assert one == two and len(one) == 5000
    share = sum(s == "validation" for s in one.values()) / 5000
    assert 0.01 < share < 0.03


def next_fit(lengths, room):
    """The rule, one sequence at a time."""
    placed, pack, position, used = [], 0, 0, 0
    for length in lengths:
        if position and used + length > room:
            pack, position, used = pack + 1, 0, 0
        placed.append((pack, position, used))
        position, used = position + 1, used + length
    return placed


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.lists(st.integers(0, 14), min_size=1, max_size=25), max_size=5),
    st.integers(1, 7),
)
def test_packer_over_any_batches(shards, batch):
    rows = [(s, k, n) for s, lengths in enumerate(shards) for k, n in enumerate(lengths)]
    frames = [
        pd.DataFrame(rows[i : i + batch], columns=["shard", "key", "n"]) for i in range(0, len(rows), batch)
    ]
    packed = list(training._pack_partition(iter(frames), room=10, length="n"))
    found = [tuple(map(int, r)) for f in packed for r in f[["pack", "pos", "offset"]].to_numpy()]
    assert found == [p for lengths in shards for p in next_fit(lengths, 10)]


def test_packs_lose_no_row_and_never_overflow(spark):
    draw = np.random.default_rng(3)
    lengths = [(int(k), int(n)) for k, n in enumerate(draw.integers(0, 130, 3000))]
    frame = spark.createDataFrame(lengths, "id long, n_tokens long").repartition(9)
    packed = training.pack_sequences(frame, "id", sequence_len=100, shard_rows=256).collect()
    assert sorted(r.id for r in packed) == list(range(3000))
    packs = defaultdict(list)
    for r in packed:
        packs[r.shard, r.pack].append(r)
    for rows in packs.values():
        if all(r.fits for r in rows):
            assert sum(r.n_tokens for r in rows) <= 100
        else:
            assert len(rows) == 1
    padded = training.pack_padding(
        training.pack_sequences(frame, "id", sequence_len=100, shard_rows=256), sequence_len=100
    )
    assert all(r.used + r.pad == 100 and 0 <= r.pad for r in padded.collect())


def test_packing_depends_on_no_gaps_between_keys(spark):
    """Sparse and named keys fill packs as dense ones do."""
    fills = []
    for key in ("id", "id * 1000003", "concat('k', id)"):
        frame = spark.range(1000).selectExpr(f"{key} AS k", "10L AS n_tokens")
        packed = training.pack_sequences(frame, "k", sequence_len=2048)
        fills.append(training.pack_padding(packed).agg(F.avg("fill")).first()[0])
    assert min(fills) > 0.9


def test_small_validation_shares(spark):
    split = training.with_split(spark.range(200_000), "id", 0.00005).groupBy("split").count().collect()
    assert 1 <= {r.split: r["count"] for r in split}["validation"] <= 40


# groups ----------------------------------------------------------------------------------


@pytest.mark.parametrize("slice_rows", [3, 1_000_000])
def test_advantages(spark, slice_rows):
    draw = random.Random(2)
    rows = [(g, i, draw.choice([0.0, 0.3, 1.0])) for g in (None, 1, 2) for i in range(30)]
    rows += [(3, 0, 0.1), (3, 1, 0.1), (3, 2, 0.1), (4, 0, 7.0)]
    frame = spark.createDataFrame(rows, "g long, i long, reward double").repartition(4)
    found = group_advantage(frame, "g", ("g", "i"), slice_rows=slice_rows).collect()
    assert len(found) == len(rows)
    groups = defaultdict(list)
    for g, _, reward in rows:
        groups[g].append(reward)
    for r in found:
        deviation = np.std(groups[r.g])
        expected = (r.reward - np.mean(groups[r.g])) / deviation if deviation > 1e-12 else 0.0
        assert r.advantage == pytest.approx(expected)
    centered = group_advantage(frame, "g", ("g", "i"), scale=False, slice_rows=slice_rows)
    sums = centered.groupBy("g").agg(F.sum("advantage").alias("s")).collect()
    assert all(abs(r.s) < 1e-9 for r in sums)


def test_fan_out(spark):
    assert [r.gen_idx for r in training.fan_out(spark.range(1), 8).collect()] == list(range(8))


# rewards ---------------------------------------------------------------------------------


def test_reward_weights_must_match():
    with pytest.raises(ValueError):
        rewards.load_rewards(["think_format_reward"], [1.0, 0.2])
    with pytest.raises(KeyError):
        rewards.load_rewards(["unheard_of"])
    loaded = rewards.load_rewards(["turnweave.operators.rewards.think_format_reward"])
    assert loaded == [(rewards.think_format_reward, 1.0)]


def test_weighted_sum_with_columns(spark):
    def right(prompt, completion, answer_key):
        return completion.endswith(answer_key).cast("double")

    rows = [("p", "<think>x</think> A", "A"), ("p", "B", "A"), ("p", None, "A")]
    frame = spark.createDataFrame(rows, "prompt string, completion string, answer_key string")
    strict = rewards.load_rewards([lambda p, c, **k: F.coalesce(right(p, c, **k), F.lit(0.0)),
                                   "think_format_reward"], [2.0, 0.5])
    found = rewards.with_reward(frame, strict, columns=["answer_key"]).collect()
    assert [(r.reward_1, r.reward_2, r.reward) for r in found] == [(1, 1, 2.5), (0, 0, 0), (0, 0, 0)]


def test_helpfulness_reward_styles(spark):
    frame = spark.createDataFrame([("ab", " <think>x</think> cd")], "prompt string, completion string")
    plain = rewards.helpfulness_reward("stub-scorer", stubs.scorer, model_id="acme/rm")
    nothink = rewards.helpfulness_reward("stub-scorer", stubs.scorer)
    row = rewards.with_reward(frame, rewards.load_rewards([plain, nothink])).first()
    assert row.reward_1 == 2 + 0.5 * 2
    assert row.reward_2 == (2 + len(" /nothink")) + 0.5 * (2 + len("<think>\n\n</think>\n\n"))


# models ----------------------------------------------------------------------------------


def test_model_gets_small_batches(spark):
    def factory():
        return lambda batch: [str(len(batch))] * len(batch)

    prompts = spark.range(0, 10, 1, 1).select(F.col("id").cast("string").alias("p"))
    sizes = [r.s for r in prompts.select(models.generate("sizes", factory, F.col("p"), 4).alias("s")).collect()]
    assert sizes == ["4"] * 8 + ["2"] * 2


def test_model_must_answer_every_input(spark):
    prompts = spark.range(3).select(F.lit("x").alias("p"))
    wrong = models.generate("wrong", lambda: lambda batch: batch[:-1], F.col("p"), 2)
    with pytest.raises(Exception, match="one output per input"):
        prompts.select(wrong.alias("s")).collect()


def test_model_is_built_once_per_worker():
    built = []
    for _ in range(3):
        models.once_per_worker("counted", lambda: built.append(1) or (lambda batch: batch))
    assert len(built) == 1


def test_models_of_one_name(spark):
    """A second factory under a name is another model, and sampling options reach it."""

    def factory(word, **options):
        return lambda batch: [f"{word} {options.get('temperature')}"] * len(batch)

    one = spark.range(1).select(F.lit("x").alias("p"))
    said = []
    for word, options in (("a", None), ("b", None), ("b", {"temperature": 0.1})):
        built = models.with_options(partial(factory, word), options)
        said.append(one.select(models.generate("same", built, F.col("p")).alias("s")).first().s)
    assert said == ["a None", "b None", "b 0.1"]


def test_message_lists_in_rewards(spark):
    kind = "array<struct<role:string,content:string>>"
    rows = [([("system", "s"), ("user", "ab")], [("assistant", "<think>x</think> cd")]), ([], [])]
    frame = spark.createDataFrame(rows, f"prompt {kind}, completion {kind}")
    plain = rewards.helpfulness_reward("stub-scorer", stubs.scorer, model_id="acme/rm")
    found = rewards.with_reward(frame, rewards.load_rewards([plain, "think_format_reward"])).collect()
    assert [(r.reward_1, r.reward_2) for r in found] == [(2 + 0.5 * 2, 1.0), (0.0, 0.0)]


def test_settings_of_rollouts(spark, tmp_path):
    """All datasets are read, columns reach the rewards, and scores are not asked for twice."""
    for name in ("a", "b"):
        (tmp_path / f"{name}.jsonl").write_text(f'{{"messages": [{{"role": "user", "content": "{name}"}}], "answer_key": "{name}"}}\n')
    seen = []

    def keyed(prompt, completion, **columns):
        seen.append(sorted(columns))
        return F.lit(1.0)

    config = {
        "datasets": [
            {"path": str(tmp_path / "a.jsonl"), "type": "messages_to_query", "keep_metadata": True},
            {"path": str(tmp_path / "b.jsonl"), "type": "messages_to_prompt", "unknown": 1, "template": None},
        ][:1]
        + [{"path": str(tmp_path / "b.jsonl"), "type": "messages_to_query", "remove_columns": ["messages"]}],
        "rewards": {"reward_funcs": ["keyed"]},
        "generate": {"max_new_tokens": 3},
    }

    def generator(**options):
        return lambda batch: [str(options["max_new_tokens"])] * len(batch)

    scored = rollouts_from_settings(spark, config, ("counted", generator), {"keyed": keyed})
    assert {r.completion for r in scored.collect()} == {"3"} and scored.count() == 2
    assert "answer_key" in seen[0] and "Python" not in scored._jdf.queryExecution().executedPlan().toString()


def test_generation_options():
    # The defaults.
    assert models.generation_options({"top_k": "None", "max_new_tokens": 5}) == {
        "max_new_tokens": 5,
        "do_sample": True,
        "temperature": 0.7,
        "top_p": 0.9,
    }


def test_evaluation_writes_all_outputs(spark, tmp_path):
    examples = spark.createDataFrame(
        [(i, [("system", "s"), ("user", f"q{i}"), ("assistant", "old")]) for i in range(6)],
        "id long, messages array<struct<role:string,content:string>>",
    )
    out = str(tmp_path / "out")
    predictions, results, summary = evaluate(
        examples,
        ("stub-generator", stubs.generator),
        ("stub-judge", stubs.judge),
        output_dir=out,
        limit=4,
        partitions=2,
    )
    assert sorted(r.id for r in predictions.collect()) == [0, 1, 2, 3]
    assert "old" not in predictions.first().query
    assert spark.read.json(f"{out}/predictions.jsonl").count() == 4
    assert spark.read.json(f"{out}/judge_results.jsonl").count() == 4
    written = spark.read.json(f"{out}/summary.json").first()
    assert written.n == 4 and written.next_algorithm == summary.first().next_algorithm
    assert set(results.first().scores) == set(BUILT_IN.keys)


def test_outputs_that_exist(spark, tmp_path):
    """They are replaced, or found before a model is asked."""
    examples = spark.createDataFrame([(0, [("user", "q")])], "id long, messages array<struct<role:string,content:string>>")
    calls = [("stub-generator", stubs.generator), ("stub-judge", stubs.judge)]
    for _ in range(2):
        evaluate(examples, *calls, output_dir=str(tmp_path / "o"))
    assert spark.read.json(f"{tmp_path}/o/predictions.jsonl").count() == 1

    def never():
        raise AssertionError("asked")

    with pytest.raises(FileExistsError):
        evaluate(examples, ("never", never), ("never", never), output_dir=str(tmp_path / "o"), mode="error")


def test_replies_need_their_setting(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "false")
    try:
        with pytest.raises(ValueError, match="configure"):
            read_replies(spark.createDataFrame([("x",)], "raw string"), BUILT_IN)
    finally:
        configure(spark)


def test_first_of_files(spark, tmp_path):
    """Rows come in the order of files and lines, and later files stay closed."""
    for name, size in (("b", 5), ("a", 3)):
        (tmp_path / f"{name}.jsonl").write_text("".join(f'{{"source_file": "{name}{i}"}}\n' for i in range(size)))
    (tmp_path / "c.jsonl").write_text("not json\n")
    files = [str(tmp_path / f"{n}.jsonl") for n in "abc"]
    for limit, wanted in ((5, ["a0", "a1", "a2", "b0", "b1"]), (8, [f"a{i}" for i in range(3)] + [f"b{i}" for i in range(5)]), (0, [])):
        found = ids.first_of_files(spark, files, lambda f: jsonl.read_jsonl(spark, f), limit)
        assert [(r.id, r.source_file) for r in found.orderBy("id").collect()] == list(enumerate(wanted))


def test_first_of_many_splits(spark, tmp_path):
    """Splits are taken in order, and those behind the limit stay closed."""
    for name in "abc":
        lines = [f'{{"source_file": "{name}{i:04}"}}' for i in range(2000)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join([*lines, "not json" if name == "b" else ""]))
    files = [str(tmp_path / f"{n}.jsonl") for n in "abc"]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")  # about ten splits a file
    try:
        assert jsonl.read_jsonl(spark, files[1]).rdd.getNumPartitions() > 5
        wanted = [f"{n}{i:04}" for n in "ab" for i in range(2000)]
        for limit in (5, 700, 2000, 2300):
            found = ids.first_of_files(spark, files, lambda f: jsonl.read_jsonl(spark, f), limit)
            assert [(r.id, r.source_file) for r in found.orderBy("id").collect()] == list(enumerate(wanted[:limit]))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_evaluation_of_a_file(spark, tmp_path):
    data = tmp_path / "eval.jsonl"
    lines = [f'{{"messages": [{{"role": "user", "content": "q{i}"}}]}}' for i in range(5)]
    data.write_text("\n\n".join(lines))
    out = str(tmp_path / "out")
    summary = evaluate_file(
        spark, str(data), ("stub-generator", stubs.generator), ("stub-judge", stubs.judge), out, limit=3
    )
    assert summary.first().n == 3
    written = spark.read.json(f"{out}/predictions.jsonl").orderBy("id").collect()
    assert [(r.id, f"q{r.id}" in r.query) for r in written] == [(0, True), (1, True), (2, True)]


# transforms and preferences --------------------------------------------------------------


@pytest.fixture
def example(spark):
    return spark.createDataFrame(
        [([("user", "a"), ("assistant", "b")], "k", "f", 1)],
        "messages array<struct<role:string,content:string>>, answer_key string, source_file string, n int",
    )


def test_query_fields(example):
    prompt = "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\n"
    assert example.transform(messages_to_query()).first().asDict() == {"query": prompt}
    kept = {"prompt": prompt, "answer_key": "k", "source_file": "f"}
    assert example.transform(messages_to_query(ppo=False)).first().asDict() == kept
    assert example.transform(messages_to_query(return_field="prompt")).first().asDict() == kept
    named = transform_from_spec(
        {"type": "messages_to_query", "path": "x.jsonl", "return_field": "ask", "keep_metadata": True}
    )
    assert example.transform(named).first().asDict() == {"ask": prompt, "answer_key": "k", "source_file": "f"}


def test_preference_formats(spark):
    frame = spark.createDataFrame(
        [(1, "p", "c", "r"), (2, None, "c", "r")], "id int, prompt string, chosen string, rejected string"
    )
    shape = PreferenceFormat("[{prompt}|{prompt}]", "{chosen} $1 \\ {other}", "{prompt}: {rejected}")
    rows = map_preferences(frame, shape).orderBy("id").collect()
    assert tuple(rows[0]) == (1, "[p|p]", "c $1 \\ {other}", "p: r", True)
    assert tuple(rows[1]) == (2, None, "c $1 \\ {other}", None, False)
    assert [r.id for r in incomplete(map_preferences(frame)).collect()] == [2]
    named = map_preferences(frame, "user_defined.anything").orderBy("id").first()
    assert tuple(named) == (1, "p", "c", "r", True)
    with pytest.raises(KeyError):
        map_preferences(frame, "unheard.of")


# files -----------------------------------------------------------------------------------


def test_jsonl_lines(spark, tmp_path):
    path = tmp_path / "in.jsonl"
    path.write_text('\n  \n{"messages": [{"role": "user", "content": "é"}], "options": ["a"]}\n\n', "utf-8")
    rows = jsonl.read_jsonl(spark, str(path)).collect()
    assert [tuple(m) for m in rows[0].messages] == [("user", "é")] and rows[0].options == ["a"]
    assert len(rows) == 1
    path.write_text('{"messages": null}\n{"messages": [\n', "utf-8")
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(path)).collect()
    kept = jsonl.read_jsonl(spark, str(path), quarantine=True).collect()
    assert [r._corrupt_record for r in kept] == [None, '{"messages": [']


def test_null_scores_are_written(spark, tmp_path):
    from turnweave.functions.judging import read_replies
    from turnweave.sources.sinks import write_judge_results

    frame = spark.createDataFrame([(7, "none", )], "id long, raw string")
    write_judge_results(read_replies(frame, BUILT_IN), str(tmp_path / "r"))
    line = spark.read.text(str(tmp_path / "r")).first().value
    assert line.startswith('{"scores":{"format_compliance":null,') and line.endswith('"id":7,"overall":0.0}')


def test_rubric_file(spark, tmp_path):
    from turnweave.sources.rubrics import load_rubric

    path = tmp_path / "rubric.json"
    path.write_text(
        '{"version": "v2", "scale": {"min": 1, "max": 10}, "judge_instructions": "Judge.",\n'
        ' "categories": [{"key": "a", "weight": 2, "instruction": "Is a?"}]}'
    )
    rubric = load_rubric(spark, str(path))
    assert (rubric.scale_min, rubric.scale_max, rubric.total_weight) == (1, 10, 2.0)
    assert load_rubric(spark) is BUILT_IN


def test_rows_of_a_large_plan_are_made_in_many_tasks(spark):
    plan = spark.range(60).selectExpr("'sft' AS alg", "IF(id % 3 = 0, 'a', 'b') AS chunk", "id AS run_id")
    rows = spark.range(40).coalesce(1).selectExpr("'sft' AS alg", "IF(id % 2 = 0, 'a', 'b') AS chunk", "id AS row")
    found = stages.stage_rows(plan, rows, max_plan_rows=10)
    pairs = found.select("chunk", "run_id", "row", F.spark_partition_id().alias("task")).collect()
    expected = Counter((c, p, r) for p in range(60) for r in range(40) if (c := "ab"[p % 3 > 0]) == "ab"[r % 2])
    assert Counter((x.chunk, x.run_id, x.row) for x in pairs) == expected
    # More tasks than the session has shuffle partitions.
    assert len({x.task for x in pairs}) > 8


def test_large_plans_and_their_rows_are_both_dealt(spark, monkeypatch):
    monkeypatch.setattr(stages, "PLACE_ROWS", 100)
    # Runs and rows that are null or come twice, and a column that has no hash.
    plan = spark.range(60).selectExpr("'sft' AS alg", "IF(id % 3 = 0, 'a', 'b') AS chunk", "IF(id % 7 > 0, id % 50, NULL) AS run_id")
    rows = spark.range(4000).selectExpr("'sft' AS alg", "IF(id % 2 = 0, 'a', 'b') AS chunk", "IF(id % 9 > 0, id % 3900, NULL) AS row", "map('k', id % 3900) AS extra")
    found = stages.stage_rows(plan, rows, max_plan_rows=10)
    assert found.columns == ["alg", "chunk", "row", "extra", "run_id"]
    pairs = found.select("chunk", "run_id", "row", F.col("extra")["k"].alias("k"), F.spark_partition_id().alias("task")).collect()
    plan_rows = [("ab"[p % 3 > 0], p % 50 if p % 7 else None) for p in range(60)]
    data_rows = [("ab"[r % 2], r % 3900 if r % 9 else None, r % 3900) for r in range(4000)]
    expected = Counter((c, p, r, k) for c, p in plan_rows for d, r, k in data_rows if c == d)
    assert Counter((x.chunk, x.run_id, x.row, x.k) for x in pairs) == expected
    # Many rows are dealt to more places than a small plan has.
    assert len({x.task for x in pairs}) > stages.SALTS


def test_pairs_of_a_large_plan_are_counted_without_groups(spark, tmp_path):
    import re

    from turnweave.catalog.staging import stage_rows_of_large_plan

    users = [None, None, 0, 0, 1, 2, 7, 8, 13]
    spark.createDataFrame([(i, u) for i, u in enumerate(users)], "event_id long, user_id long").write.parquet(str(tmp_path / "events.parquet"))
    turns = [(c, t, r) for c in (0, 1, 1, 2, 3, 4, None) for t in (0, 1, None) for r in ("user", "assistant")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string").write.parquet(str(tmp_path / "conversations.parquet"))
    chunks = {("sft", 0): 1, ("sft", 1): 2, ("sft", 2): 4, ("dpo", 0): 2, ("dpo", 1): 4}
    plan = []
    for user in set(users):
        for series, mask in enumerate([None, None] if user is None else [user % 8, (user + 6) % 8], 1):
            for stage in range(3):
                alg = "dpo" if stage and mask is not None and mask >> stage & 1 else "sft"
                plan.append((alg, chunks[alg, stage - (alg == "dpo")], (mask, series, stage)))
    sizes = Counter(c % 4 + 1 for c, _, r in turns if r == "user" and c is not None)
    n_rows, runs = Counter(), defaultdict(set)
    for alg, chunk, run in plan:
        n_rows[alg, f"chunk{chunk}"] += sizes[chunk]
        runs[alg, f"chunk{chunk}"] |= {run}
    counted = stage_rows_of_large_plan(spark, str(tmp_path))
    found = {(x.alg, x.chunk): (x.n_rows, x.n_runs) for x in counted.collect()}
    assert found == {key: (n, len(runs[key])) for key, n in n_rows.items()}
    # Pairs are counted where they are made: none is looked up in a table of groups.
    steps = counted._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"HashAggregate\(keys=\[\], functions=\[partial_count\(", steps)
