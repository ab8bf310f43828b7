"""Resource recommendations from timed samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldmill.fixed_values import MEMORY_FLOOR_MB, SAFETY_FACTOR_MEM, SAFETY_FACTOR_TIME
from foldmill.functions import durations


def per_sample(timed: DataFrame) -> DataFrame:
    """Samples with whole seconds and megabytes.

    ``timed`` has ``tier, seqname, length, n_shuffles, wall, rss_kb``; a sample
    that failed has a null ``wall`` and is left out.
    """
    return timed.filter(F.col("wall").isNotNull()).select(
        "tier", "seqname", "length", "n_shuffles",
        durations.whole_seconds(F.col("wall")).alias("wall_s"),
        durations.kb_to_mb(F.col("rss_kb")).alias("rss_mb"))


def recommend(samples: DataFrame, time_factor: int = SAFETY_FACTOR_TIME,
              memory_factor: int = SAFETY_FACTOR_MEM) -> DataFrame:
    """Per tier: largest sample and the resources to ask for. Empty tiers have no row."""
    largest = samples.groupBy("tier", "n_shuffles").agg(
        F.count("*").cast("int").alias("n_samples"),
        F.max("length").alias("max_len"),
        F.max("wall_s").alias("max_wall_s"),
        F.max("rss_mb").alias("max_rss_mb"))
    memory = F.greatest(F.lit(MEMORY_FLOOR_MB), F.col("max_rss_mb") * memory_factor)
    return largest.select(
        "tier", "n_shuffles", "n_samples", "max_len", "max_wall_s", "max_rss_mb",
        durations.clock_minutes(F.col("max_wall_s") * time_factor).alias("rec_time"),
        F.concat(memory.cast("string"), F.lit("MB")).alias("rec_mem"))
