"""A corpus made ready for training: five stages over the documents table.

Each stage works on all rows its predecessor kept. What a stage returns is written as Parquet and
read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnweave.llm.decontaminate import decontaminate
from turnweave.llm.ngram_join import one_of_each_group
from turnweave.llm.pseudonyms import pseudonymize
from turnweave.llm.sentence_fst import encode_pieces
from turnweave.llm.toxicity import drop_toxic
from turnweave.session import materialize


#: Of the test tables; a real one is kept secret.
PSEUDONYM_KEY = "key of the test tables"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` follows a changed text."""
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents with similar shingle sets the one of the smallest id stays."""
    return one_of_each_group(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages go from contaminated documents, and documents that are nothing else."""
    return _counted(decontaminate(docs, _table(spark, sf_dir, "benchmark")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses become pseudonyms."""
    return _counted(pseudonymize(docs, key=PSEUDONYM_KEY))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each text as pieces, and the text that they decode to."""
    names = [c for c in docs.columns if c not in ("text", "piece_ids", "n_pieces")]
    decoded = encode_pieces(docs, decoded="_decoded")
    return decoded.select(*[F.col(f"`{c}`") for c in names], F.col("_decoded").alias("text"), "piece_ids", "n_pieces")


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("benchmark", benchmark),
    ("personal_data", personal_data),
    ("pieces", pieces),
]

#: The classifier, the pseudonyms and the pieces are beyond SQL; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
