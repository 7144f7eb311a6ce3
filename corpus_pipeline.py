"""A corpus preparation pipeline out of the operators of ``assayworks.llm``.

Each stage takes the documents that its predecessor kept and returns documents of
the same columns; the last returns what goes into training sequences.

In every stage a null text is empty, repeated rows are rows of their own (the second
stage keeps one of them), and an empty table gives an empty one.  A null ``doc_id`` is
an id like another, but has no label.  Columns beyond those of documents go along under
any name.  Ties are settled where they arise: of near copies the smallest id stays, of
pieces of one length the smaller id is placed first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayworks.llm import decontamination, minhash_dedup, packing, pii, quality
from assayworks.llm.queries import tokenizer_path
from assayworks.llm.shared import forget, release, table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their sites speak against go."""
    return quality.reject(docs, table(spark, sf_dir, "labels"), F.col("source"), F.concat_ws("/", "source", "lang"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, a similarity of 0.8 or more."""
    return minhash_dedup.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of the benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data, secrets and terms that disclose them are masked; every document stays, and ``n_chars`` is that of its new text."""
    return pii.sanitise(docs).withColumn("n_chars", F.length("text").cast("long"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer_path(), packing.WEIGHED)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]

#: Trained evidence, signatures and packing have no form in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        kept = written(made, name)
        release(made)
        forget(docs)
        docs = kept
    return docs
