"""A training corpus from raw documents in five stages.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; it works on all its
predecessor kept, written as Parquet and read again. All but the last return
the columns of ``documents``. Thresholds: quality score of at least 0.7 stays;
near-duplicates are five-word shingle sets with a similarity of 0.8 or more,
the smallest id of a group stays; a benchmark item with at most 5 % edits
removes its document; personal data is replaced by its kind; the rest is
packed into sequences of at most 2048 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobsight.llm.common import read, saved
from jobsight.llm.decontaminate import drop_leaks
from jobsight.llm.minhash import keep_one
from jobsight.llm.packing import pack_documents
from jobsight.llm.pii import sanitise
from jobsight.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rule ensemble accepts."""
    return keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return keep_one(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs."""
    return drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with personal data and disclosing terms generalised."""
    return sanitise(docs, min_term=1)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece, with its ids and its place."""
    return pack_documents(docs, with_ids=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: A classifier, hashing, edit distances and a tokenizer: SQL expresses none of the stages' decisions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
