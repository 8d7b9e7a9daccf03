"""The corpus pipeline over documents(doc_id, text, lang, source, n_chars).

Toxic documents go, one document of each group of near duplicates stays,
benchmark passages are cut out (documents that mostly consist of them go),
personal data is replaced by its kind, and the sources are mixed to target
weights. Every stage but the last returns the columns of documents; the last
adds `copies`, how often the mix reads a document, and leaves out those it does
not take. Stages are written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm.bag_minhash import keep_one_of_each
from tallyframe.llm.common import stored
from tallyframe.llm.cube_mix import apply_mix
from tallyframe.llm.decontaminate import remove_benchmark_spans
from tallyframe.llm.pii import sanitise
from tallyframe.llm.toxicity import drop_toxic

COLUMNS = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.col(name).cast(kind).alias(name) for name, kind in COLUMNS.items()))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3; a text without words is not toxic."""
    return drop_toxic(_documents(docs), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class of near duplicates; repeated rows once."""
    return keep_one_of_each(_documents(docs))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Runs of ten or more words of a benchmark item cut out; documents with more than half their words hit go."""
    return remove_benchmark_spans(_documents(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Entities replaced by their kind, words that disclose one generalised or removed; no document goes."""
    return sanitise(_documents(docs))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies of each."""
    return apply_mix(_documents(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("mixing", mixing),
]

# The stages fit models, hash signatures and draw balanced samples: SQL cannot express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
