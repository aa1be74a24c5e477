"""A corpus made ready for training: filtered, deduplicated, decontaminated, mixed, tokenized."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontamination, mixing, near_duplicates, token_files, toxicity
from plumbline.llm.common import shared_folder
from plumbline.llm.queries import table, tokenizer_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are scored as toxic (0.5 or more) go."""
    training = toxicity.fold(F.col("doc_id"), 5) != 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), training)
    return toxicity.without_toxic(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return near_duplicates.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    return decontamination.without_items(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture: written, the part files hold them in it."""
    names = ("_mix_block", "_mix_slot", "_mix_position")
    return mixing.mix(docs, names=names).orderBy(names[2]).select(*docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of all documents, written in the order of the part files and read back."""
    order = token_files.file_order(docs)
    files = token_files.write_tokens(
        docs, shared_folder(spark), tokenizer_path(), order=order, forget=True
    )
    return token_files.token_digests(token_files.read_tokens(files))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_files", tokenized),
]

#: SQL cannot say what the learned filter and the fingerprints decide.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet and read again."""
    folder = shared_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
