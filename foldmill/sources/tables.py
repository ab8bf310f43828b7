"""Delimited tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.fixed_values import (
    LENGTHS_SCHEMA, MANIFEST_SCHEMA, RAW_SCHEMA, RECOMMENDATION_SCHEMA, RESULT_SCHEMA)
from foldmill.operators.collate import latest_manifest
from foldmill.sources.headed import read_headed


def manifest_rows(spark: SparkSession, path: str) -> DataFrame:
    """All manifest rows, in no order."""
    rows = read_headed(spark, path, MANIFEST_SCHEMA, sep="\t")
    if rows is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return rows.drop("pos")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest rows; a sequence listed twice keeps its last row."""
    rows = read_headed(spark, path, MANIFEST_SCHEMA, sep="\t")
    if rows is None:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return latest_manifest(rows, ["pos"]).drop("pos")


def read_results(spark: SparkSession, path: str, pattern: str = "results_*.csv",
                 standard: bool = True, placed: bool = False) -> DataFrame:
    """Result rows of all files that match ``pattern``; ``NA`` is null.

    Every file is read by its own header. ``standard=False`` keeps further columns of the files, as
    text; ``placed=True`` keeps ``pos``, which sorts the rows as in the files. Raises where nothing matches.
    """
    rows = read_headed(spark, path, RESULT_SCHEMA, extra=not standard, pattern=pattern, null="NA")
    if rows is None:
        raise FileNotFoundError(f"{path} has no file {pattern} with a header")
    return rows if placed else rows.drop("pos")


def read_raw_shuffles(spark: SparkSession, path: str, pattern: str = "*_raw_shuffles.csv",
                      placed: bool = False) -> DataFrame | None:
    """Shuffle rows of all files that match, or None when there are none. ``placed`` as above."""
    rows = read_headed(spark, path, RAW_SCHEMA, pattern=pattern)
    return rows if rows is None or placed else rows.drop("pos")


def read_lengths(spark: SparkSession, path: str, tier: int | None = None) -> DataFrame:
    """The headerless lengths table, of one tier or of all."""
    rows = spark.read.schema(LENGTHS_SCHEMA).options(sep="\t").csv(path)
    return rows if tier is None else rows.filter(F.col("tier") == tier)


def read_recommendations(spark: SparkSession, path: str) -> DataFrame:
    rows = read_headed(spark, path, RECOMMENDATION_SCHEMA, sep="\t")
    if rows is None:
        raise FileNotFoundError(f"no recommendations in {path}")
    return rows.drop("pos")
