"""Exact medians of groups of any size, by counting.

``median`` keeps all of a group's distinct values in one buffer, and sorting a group by range
shuffles every row. Here a group is cut into cells by approximate quantiles, the rows of each
cell are counted, and the next pass looks only into the cells that hold the two middle places.
Passes aggregate on the map side, so a hot group shrinks to its quantiles and counts before
it leaves a task. Quantiles only decide where cells begin; the counts are exact, and so is the result.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldmill.functions.stats import weighted_at, weighted_median
from foldmill.operators import keys
from foldmill.session import settle

FINAL_ROWS = 25_000   # distinct values of a group that meet in one row at the end, about
CELLS = 32            # of a group in each pass
ACCURACY = 20 * CELLS
# Two cells may hold the middle places; each has this share of the values at most.
_SHARE = 2 * (1 / CELLS + 2 / ACCURACY)


def passes(largest: int, final_rows: int = FINAL_ROWS) -> int:
    """Passes until a group of ``largest`` distinct values has ``final_rows`` left."""
    number = 0
    while largest > final_rows:
        largest, number = min(largest - 1, int(largest * _SHARE) + 1), number + 1
    return number


def _on(rows: DataFrame, facts: DataFrame, key: Sequence[str], few: bool) -> DataFrame:
    """``rows`` with the columns of ``facts``, one row per group; a null key matches itself."""
    facts = facts.withColumnsRenamed({k: f"_{k}_" for k in key})
    same = reduce(and_, [rows[k].eqNullSafe(facts[f"_{k}_"]) for k in key])
    return rows.join(F.broadcast(facts) if few else facts, same).drop(*(f"_{k}_" for k in key))


def _narrowed(inside: DataFrame, key: Sequence[str], value: str, weight: str, few: bool) -> DataFrame:
    """``n, before, lo, hi`` per group: weight of all rows, weight below the cells that hold the middle
    places, and the least and greatest value of these cells. ``inside`` has n and before."""
    cuts = F.percentile_approx(value, [i / CELLS for i in range(1, CELLS)], ACCURACY)
    split = inside.groupBy(*key).agg(cuts.alias("_cuts"))
    # Compared one by one, so that it is compiled; an array function would call a lambda per cut.
    cell = reduce(add, [F.when(F.get("_cuts", F.lit(i)) < F.col(value), 1).otherwise(0) for i in range(CELLS - 1)])
    cells = _on(inside, split, key, few).groupBy(*key, cell.alias("_cell")).agg(
        F.sum(weight).alias("_own"), F.min(value).alias("_lo"), F.max(value).alias("_hi"),
        F.max("n").alias("n"), F.max("before").alias("before"))
    # At most CELLS rows per group.
    below = Window.partitionBy(*key).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum("_own").over(below), F.lit(0))
    low, high = _middle(F.col("n"))
    holds = (F.col("_start") <= high) & (F.col("_start") + F.col("_own") > low)
    return cells.withColumn("_start", start).filter(holds).groupBy(*key).agg(
        F.max("n").alias("n"), F.min("_start").alias("before"), F.min("_lo").alias("lo"), F.max("_hi").alias("hi"))


def _middle(n: Column) -> tuple[Column, Column]:
    """The two middle places of n sorted values, from 0."""
    return F.floor((n - 1) / 2), F.floor(n / 2)


def counted_median(counted: DataFrame, key: Sequence[str], value: str, weight: str, largest: int,
                   groups: int, final_rows: int = FINAL_ROWS) -> DataFrame:
    """``key, n, median`` of rows that stand for ``weight`` equal values each.

    ``largest`` is the number of rows of the largest group, ``groups`` the number of groups; both
    were counted, the second bounds what is broadcast. Nothing is sorted but the last
    ``final_rows`` or so of each group, which meet in one row.
    """
    few = groups <= keys.BROADCAST_ROWS
    pair = F.struct(F.col(value).alias("v"), F.col(weight).alias("w"))
    values = F.sort_array(F.collect_list(pair)).alias("_values")
    left = passes(largest, final_rows)
    if not left:
        whole = counted.groupBy(*key).agg(values, F.sum(weight).alias("n"))
        return whole.select(*key, "n", weighted_median(F.col("_values"), F.col("n")).alias("median"))
    totals = counted.groupBy(*key).agg(F.sum(weight).alias("n"))
    inside = _on(counted, totals.withColumn("before", F.lit(0).cast("bigint")), key, few)
    for n in range(left):
        facts = _narrowed(inside, key, value, weight, few)
        # A pass reads its input twice, so all but the last are stored.
        facts = facts if n == left - 1 else settle(facts)
        inside = _on(counted, facts, key, few).filter(F.col(value).between(F.col("lo"), F.col("hi"))).drop("lo", "hi")
    last = inside.groupBy(*key).agg(values, F.max("n").alias("n"), F.max("before").alias("before"))
    low, high = (place - F.col("before") for place in _middle(F.col("n")))
    return last.select(*key, "n", weighted_at(F.col("_values"), low, high).alias("median"))


def grouped_median(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Exact median per group, whatever the group sizes. Null values are left out."""
    counted = settle(df.filter(F.col(value).isNotNull())
                     .groupBy(*group, value).agg(F.count("*").alias("_weight")))
    sizes = counted.groupBy(*group).agg(F.count("*").alias("rows"))
    found = sizes.agg(F.max("rows").alias("largest"), F.count("*").alias("groups")).first()
    return counted_median(counted, group, value, "_weight", found["largest"] or 0, found["groups"])
