"""A corpus pipeline: filter, near-dedup, substring dedup, mix, pack.

Each stage takes all that the one before kept. All but the last return the columns of
``documents``; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.llm.lempel_ziv import duplicate_spans
from foldmill.llm.line_quality import keep_good
from foldmill.llm.near_copies import keep_one
from foldmill.llm.packing import pack
from foldmill.llm.raking import mix
from foldmill.llm.store import settle

# Line labels, near copies and packing have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line classifier, learned from ``labels``, does not reject."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by Jaccard similarity 0.8 or more, in five-word shingles, the one of
    smallest id. Links are found by SimHash fingerprints and beyond their distance by MinHash bands."""
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages of 20 words that also start earlier.

    A text that loses nothing stays as it is; else its words are joined by one space. A document
    that loses all of its words goes; one that had none stays. ``n_chars`` is counted anew.
    """
    found = duplicate_spans(docs, carry=True).filter("n_removed = 0 or n_removed < n_words")
    text = F.col("kept_text")
    made = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.length(text)}
    return found.select(*(
        made.get(f.name, F.col(f"rest.`{f.name}`")).cast(f.dataType).alias(f.name)
        for f in docs.schema))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens follow flattened shares of source, language and topic."""
    return mix(docs).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of all texts in sequences of at most 2048 tokens."""
    return pack(docs)


STAGES = [("quality classifier", quality), ("Jaccard near-dedup", near_duplicates),
          ("substring dedup", repeated_passages), ("mixing to target weights", mixture),
          ("best-fit packing", packing)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each on the stored rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
