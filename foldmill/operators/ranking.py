"""Positions in groups of any size.

A window over a whole group puts that group in one task, which does not hold when one
group has a third of all rows. Here rows are range-sorted on (group, order), so a large
group spreads over many partitions; the sorted rows are written once, and one
small row per (group, partition) tells where each partition starts in its group.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldmill.operators.keys import measured
from foldmill.session import settle

_PART = "_part"
_SEQ = "_seq"
_TIE = "_tie"


def pin_sorted(df: DataFrame, group: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """``df`` range-sorted on (group, order) and settled.

    Adds ``_part``, the partition, and ``_seq``, the place in the sorted data. Both
    are written once, so later reads agree even after an executor is lost.
    """
    keys = [*group, *order]
    return settle(df.repartitionByRange(*keys)
                  .sortWithinPartitions(*keys)
                  .withColumn(_SEQ, F.monotonically_increasing_id())
                  .withColumn(_PART, F.shiftright(F.col(_SEQ), 33)))


def _starts(pinned: DataFrame, group: Sequence[str], weight: Column) -> DataFrame:
    """Per (group, partition): weight before it in the group, own weight, total."""
    parts = pinned.groupBy(*group, _PART).agg(
        F.sum(weight).alias("_own"), F.min(_SEQ).alias("_first"))
    in_group = Window.partitionBy(*group)
    before = in_group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return measured(parts.select(
        *group, _PART, "_own", "_first",
        F.coalesce(F.sum("_own").over(before), F.lit(0)).alias("_before"),
        F.sum("_own").over(in_group).alias("_total")))


def _with_starts(pinned: DataFrame, starts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Joins on (group, partition); a null group matches itself."""
    on = [*group, _PART]
    right = starts.withColumnsRenamed({c: f"{c}__r" for c in on})
    same = reduce(and_, [pinned[c].eqNullSafe(right[f"{c}__r"]) for c in on])
    return pinned.join(right, same).drop(*[f"{c}__r" for c in on])


def with_index(df: DataFrame, group: Sequence[str], order: Sequence[str | Column],
               name: str = "idx") -> DataFrame:
    """Adds the 0-based place of each row in its group, or in all rows for no group.

    Rows that tie in ``order`` are also ordered by the partition they come from, so
    many equal rows spread over several ranges.
    """
    pinned = pin_sorted(df.withColumn(_TIE, F.spark_partition_id()), group, [*order, _TIE])
    starts = _starts(pinned, group, F.lit(1)).select(*group, _PART, "_first", "_before")
    return (_with_starts(pinned, starts, group)
            .withColumn(name, F.col("_before") + F.col(_SEQ) - F.col("_first"))
            .drop(_PART, _SEQ, _TIE, "_first", "_before"))
