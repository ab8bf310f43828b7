"""What to run: task lists and their resources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.fixed_values import CONCURRENT_LIMIT, DEFAULT_MEMORY, DEFAULT_TIME
from foldmill.operators.ranking import with_index


def index_tasks(tasks: DataFrame, group: Sequence[str], order: Sequence[str | Column],
                name: str = "idx") -> DataFrame:
    """Adds each task's 0-based place in its list."""
    return with_index(tasks, group, order, name)


def task_at(indexed: DataFrame, index: int, name: str = "idx") -> DataFrame:
    """The task at one place of each list."""
    return indexed.filter(F.col(name) == index)


def array_range(count: Column, limit: int = CONCURRENT_LIMIT) -> Column:
    """Index range of an array job with its concurrency limit."""
    return F.format_string("0-%d%%%d", count - 1, F.lit(limit))


def tier_plan(tiered: DataFrame, recommendations: DataFrame,
              limit: int = CONCURRENT_LIMIT) -> DataFrame:
    """One row per tier that has both tasks and a recommendation."""
    sizes = tiered.groupBy("tier").agg(F.count("*").alias("n_tasks"))
    return recommendations.join(sizes, "tier").select(
        F.concat(F.lit("t"), F.col("tier").cast("string")).alias("tag"),
        "tier", "n_tasks", "n_shuffles", "rec_time", "rec_mem",
        array_range(F.col("n_tasks"), limit).alias("array_range"))


def list_plan(tasks: DataFrame, n_shuffles: int, time: str = DEFAULT_TIME,
              memory: str = DEFAULT_MEMORY, limit: int = CONCURRENT_LIMIT) -> DataFrame:
    """One row for an explicit list of tasks, or none if the list is empty."""
    return (tasks.agg(F.count("*").alias("n_tasks")).filter(F.col("n_tasks") > 0)
            .select(F.lit("custom").alias("tag"), F.lit(None).cast("int").alias("tier"),
                    "n_tasks", F.lit(n_shuffles).alias("n_shuffles"),
                    F.lit(time).alias("rec_time"), F.lit(memory).alias("rec_mem"),
                    array_range(F.col("n_tasks"), limit).alias("array_range")))
