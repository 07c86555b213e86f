"""The corpus pipeline: raw documents to token ids, each stage one of the corpus operators.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a DataFrame; ``run``
writes it to the shared folder and reads it again for the next stage. All stages but the last return the columns of
``documents``. Decisions take effect: rejected documents, further members of a group of near copies and documents that hold
a benchmark item are gone; secrets are masked in the text.
"""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from faremill.llm import decontamination, ngram_join, quality_model, secrets, sentencepieces
from faremill.llm.queries import MODEL_FILE
from faremill.llm.store import saved

#: Near copies: Jaccard similarity in a hundred of the sets of word shingles of this width.
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant accepts; empty texts are judged like any other."""
    return quality_model.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id. Rows without a shingle all stay."""
    return ngram_join.one_of_each(docs, width=SHINGLE_WORDS, percent=SIMILAR_PERCENT)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secrets.redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, parity and round_trip of every document."""
    return sentencepieces.encoded(docs, Path(MODEL_FILE).read_bytes())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark", benchmark),
    ("secret_scan", secret_scan),
    ("token_ids", token_ids),
]

#: The discriminant, the similarity groups and the token ids are beyond SQL; tests use brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
