"""What the tasks of a tier may use, from its recommendation."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.resource import ExecutorResourceRequests, ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import Row, SparkSession

# Memory of a Python worker besides the folding program, in MB.
WORKER_MB = 512


def supported(spark: SparkSession) -> bool:
    """Whether the cluster can give executors of a profile's size: it has to allocate them as
    they are asked for, which local mode does not."""
    local = spark.sparkContext.master.startswith("local")
    return not local and spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true"


def tier_profile(memory_mb: int, cores: int = 1) -> ResourceProfile:
    """Executors whose Python workers, one per core, each have room for the folding program."""
    need = ExecutorResourceRequests().cores(cores).pysparkMemory(f"{(memory_mb + WORKER_MB) * cores}m")
    return ResourceProfileBuilder().require(need).require(TaskResourceRequests().cpus(1)).build


def tier_profiles(spark: SparkSession, recommendations: Iterable[Row], cores: int = 1) -> dict[int, ResourceProfile]:
    """One profile per tier with a recommendation (``tier``, ``max_rss_mb``, ``rec_mem``), tiers of
    equal memory sharing one; none where the cluster does not support them."""
    if not supported(spark):
        return {}
    memory = {row.tier: int(row.rec_mem.upper().removesuffix("MB")) for row in recommendations if row.rec_mem}
    made = {mb: tier_profile(mb, cores) for mb in set(memory.values())}
    return {tier: made[mb] for tier, mb in sorted(memory.items())}
