"""Length tiers: assignment, counts, and the longest sequences of each tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.fixed_values import SAMPLES_PER_TIER, TIER_BOUNDS, TIER_SHUFFLES
from foldmill.functions import tiers
from foldmill.operators.keys import lacking_key, top_rows


def assign_tiers(sequences: DataFrame, length: str = "length",
                 bounds: Sequence[int] = TIER_BOUNDS,
                 shuffles: Sequence[int] = TIER_SHUFFLES) -> DataFrame:
    """Adds ``tier`` and ``n_shuffles``. Re-tiering is a change of arguments."""
    tiers.check_policy(bounds, shuffles)
    return (sequences.withColumn("tier", tiers.tier_of(F.col(length), bounds))
            .withColumn("n_shuffles", tiers.tier_shuffles(F.col("tier"), shuffles)))


def all_tiers(spark: SparkSession) -> DataFrame:
    return spark.range(1, 11).select(F.col("id").cast("int").alias("tier"))


def tier_counts(tiered: DataFrame, bounds: Sequence[int] = TIER_BOUNDS) -> DataFrame:
    """Rows per tier, empty tiers included."""
    counts = tiered.groupBy("tier").agg(F.count("*").alias("count"))
    return (all_tiers(tiered.sparkSession).join(counts, "tier", "left")
            .select("tier", tiers.tier_range(F.col("tier"), bounds).alias("range"),
                    F.coalesce("count", F.lit(0)).alias("count")))


def with_total(counts: DataFrame) -> DataFrame:
    """The tier counts and a last row with their total."""
    return (counts.groupingSets([["tier", "range"], []], "tier", "range")
            .agg(F.sum("count").alias("count"))
            .withColumn("range", F.coalesce("range", F.lit("total"))))


def longest_per_tier(tiered: DataFrame, count: int = SAMPLES_PER_TIER,
                     length: str = "length", name: str = "seqname") -> DataFrame:
    """The ``count`` longest sequences of each tier; equal lengths by name, descending."""
    return top_rows(tiered, ["tier"], [F.col(length).desc(), F.col(name).desc()], count)


def orphan_sequences(sequences: DataFrame, manifest: DataFrame) -> DataFrame:
    """Sequences the manifest does not list."""
    return lacking_key(sequences, manifest, ["seqname"])
