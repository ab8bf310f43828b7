"""Annotation files (GFF3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.functions.attributes import is_comment
from foldmill.sources.text import ordered_lines


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """Annotation lines as ``raw`` and ``pos``, comments left out."""
    return ordered_lines(spark, path).filter(~is_comment(F.col("raw")))


def parse_columns(lines: DataFrame) -> DataFrame:
    """Adds the nine columns of a line; numbers that do not parse are null."""
    fields = F.split(F.col("raw"), "\t")
    names = ["seqid", "source", "type", "start", "end", "score", "strand", "phase", "attrs"]
    columns = {name: F.get(fields, F.lit(i)) for i, name in enumerate(names)}
    for number in ("start", "end"):
        columns[number] = columns[number].try_cast("bigint")
    return lines.withColumns(columns)
