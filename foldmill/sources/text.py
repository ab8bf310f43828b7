"""Text lines with their place in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldmill.operators.transcripts import requested_genes


def place_in_file() -> Column:
    """Sorts the rows of a file source as in the files.

    A split's start offset orders the splits of a file, and the generated id
    orders the rows of a split, so no pass over the data is needed.
    """
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"))


def ordered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``raw`` and ``pos`` per line; ``pos`` sorts lines as in the files."""
    return spark.read.text(path).select(F.col("value").alias("raw"), place_in_file().alias("pos"))


def read_gene_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct clean ids of a file with one id per line."""
    return requested_genes(spark.read.text(path))


def read_whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``path`` and ``content``, one row per file matching ``pattern``."""
    return (spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
            .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content")))
