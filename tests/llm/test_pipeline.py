"""The pipeline's stages against plain Python on a small corpus."""

import random
import re

import corpus_pipeline
from turnweave.llm.sentence_fst import load

INSULTS = ["idiot", "moron", "scum", "worthless"]


def corpus(spark, folder):
    draw = random.Random(2)
    word = lambda: "".join(draw.choice("aeioulnrst") for _ in range(draw.randint(2, 7)))
    clean = [[word() for _ in range(120)] for _ in range(60)]
    items = [" ".join(word() for _ in range(20)) for _ in range(3)]
    docs, labels = [], []
    for i, words in enumerate(clean):
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 0))
    for i in range(100, 140):
        words = [word() for _ in range(100)]
        for _ in range(8):
            words[draw.randrange(100)] = draw.choice(INSULTS)
        docs.append((i, " ".join(words), "en"))
        labels.append((i, 1))
    docs.append((200, " ".join([*clean[0][:60], "changed", *clean[0][61:]]), "en"))  # a near copy of 0
    docs.append((201, " ".join(clean[1]), "en"))  # an exact one of 1
    docs.append((202, f"Start. {items[0]} and {' '.join(clean[2][:30])} end.", "en"))
    docs.append((203, items[1], "en"))
    docs.append((204, "Call +1 (743) 555-3824 or write to the.19@mail5.example.com about that", "en"))
    docs.append((205, None, None))
    docs.append((206, "", "en"))
    spark.createDataFrame([(*d, len(d[1] or "")) for d in docs], "doc_id long, text string, lang string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    docs, items = corpus(spark, folder)
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    toxic = set(range(100, 140))
    assert len(toxic & set(rows)) <= 2
    assert set(range(60)) <= set(rows)
    assert not {200, 201, 203} & set(rows)
    text = dict((d, t) for d, t, _ in docs)
    for i in range(60):
        assert rows[i].text == text[i]
    assert items[0] not in rows[202].text and rows[202].text.startswith("Start.") and rows[202].text.endswith("end.")
    assert re.fullmatch(r"Call \+1 \(\d{3}\) \d{3}-\d{4} or write to [a-z]{3}\.\d\d@mail5\.example\.com about that", rows[204].text)
    assert "743" not in rows[204].text and "the.19" not in rows[204].text
    assert rows[205].text == rows[206].text == "" and rows[205].n_pieces == 0
    decode = load().decode
    for row in rows.values():
        assert decode(row.piece_ids) == row.text and len(row.piece_ids) == row.n_pieces
        assert row.n_chars in (None, len(row.text))


def test_stages_keep_the_columns(spark, tmp_path):
    corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        done = stage(spark, docs, str(tmp_path))
        assert done.columns == docs.columns, name
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0


def test_extra_columns_with_clashing_names(spark, tmp_path):
    corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").limit(20)
    for name in ("n_words", "score", "_text", "key", "gram", "piece_ids", "_decoded"):
        docs = docs.selectExpr("*", f"'x' AS `{name}`")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, str(tmp_path)).count() <= 20, name
