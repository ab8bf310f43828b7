"""Robust scores of observed energies against their shuffled background."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from foldmill.fixed_values import FEW_SHUFFLES, INVALID_ENERGY, MIN_VALID_PERCENT
from foldmill.functions import stats
from foldmill.operators import keys
from foldmill.operators.selection import FINAL_ROWS, counted_median
from foldmill.session import settle


def counted_values(background: DataFrame, key: Sequence[str], value: str = "mfe") -> DataFrame:
    """Each group's distinct values with ``_weight``, how often each occurs, stored once.

    Counting shrinks a background of many equal values before it is shuffled. A null key matches
    no observed row and a null value is no value, so such rows go first, however many.
    """
    return settle(background.na.drop(subset=[*key, value])
                  .groupBy(*key, value).agg(F.count("*").alias("_weight")))


def summarise_counted(observed: DataFrame, counted: DataFrame, key: Sequence[str],
                      observed_value: str = "orig_mfe", value: str = "mfe") -> DataFrame:
    """Adds ``n_valid``, ``median_mfe``, ``mad`` and ``at_most`` to ``observed``.

    For groups with a bounded number of distinct values, which meet in one row. Rows of
    ``observed`` without a background are kept.
    """
    pair = F.struct(F.col(value).alias("v"), F.col("_weight").alias("w"))
    values = counted.groupBy(*key).agg(F.sort_array(F.collect_list(pair)).alias("_values"),
                                       F.sum("_weight").alias("n_valid"))
    rows = observed.join(values, list(key), "left")
    total = F.col("n_valid")
    rows = rows.withColumn("median_mfe", stats.weighted_median(F.col("_values"), total))
    apart = F.sort_array(F.transform("_values", lambda p: F.struct(
        F.abs(p["v"] - F.col("median_mfe")).alias("v"), p["w"].alias("w"))))
    at_most = F.aggregate(
        F.filter("_values", lambda p: p["v"] <= F.col(observed_value)), F.lit(0).cast("bigint"),
        lambda sum_, p: sum_ + p["w"])
    return (rows.withColumn("mad", stats.weighted_median(apart, total))
            .withColumn("at_most", F.coalesce(at_most, F.lit(0).cast("bigint")))
            .withColumn("n_valid", F.coalesce("n_valid", F.lit(0).cast("bigint")))
            .drop("_values"))


def summarise_arrays(rows: DataFrame, observed_value: str = "orig_mfe") -> DataFrame:
    """Replaces ``_values``, a sorted array, by its summary columns."""
    return (rows
            .withColumn("median_mfe", stats.median_of_sorted(F.col("_values")))
            .withColumn("mad", stats.median_of_sorted(F.sort_array(F.transform(
                "_values", lambda v: F.abs(v - F.col("median_mfe"))))))
            .withColumn("n_valid", F.coalesce(F.size("_values"), F.lit(0)).cast("bigint"))
            .withColumn("at_most", F.coalesce(F.size(F.filter(
                "_values", lambda v: v <= F.col(observed_value))), F.lit(0)).cast("bigint"))
            .drop("_values"))


def summarise_by_counting(observed: DataFrame, counted: DataFrame, key: Sequence[str], largest: int,
                          groups: int, observed_value: str = "orig_mfe", value: str = "mfe",
                          final_rows: int = FINAL_ROWS) -> DataFrame:
    """Same columns as :func:`summarise_counted`, for groups with any number of distinct values.

    Both medians are found by counting, so no group is sorted or gathered. ``largest`` and
    ``groups`` are the distinct values of the largest group and the number of groups.
    """
    key, few = list(key), groups <= keys.BROADCAST_ROWS
    medians = settle(counted_median(counted, key, value, "_weight", largest, groups, final_rows)
                     .withColumnRenamed("median", "median_mfe"))
    by_key = F.broadcast(medians) if few else medians
    # Two values as far from the median stay two rows; their weights are counted alike.
    apart = counted.join(by_key.drop("n"), key).select(
        *key, F.abs(F.col(value) - F.col("median_mfe")).alias("_spread"), "_weight")
    mads = counted_median(apart, key, "_spread", "_weight", largest, groups, final_rows).select(
        *key, F.col("median").alias("mad"))
    limits = observed.select(*key, F.col(observed_value).alias("_limit"))
    at_most = (counted.join(F.broadcast(limits) if few else limits, key).filter(F.col(value) <= F.col("_limit"))
               .groupBy(*key).agg(F.sum("_weight").alias("at_most")))
    return (observed.join(by_key, key, "left").join(mads, key, "left").join(at_most, key, "left")
            .withColumn("n_valid", F.coalesce("n", F.lit(0)))
            .withColumn("at_most", F.coalesce("at_most", F.lit(0)))
            .drop("n"))


def summarise(observed: DataFrame, background: DataFrame, key: Sequence[str],
              observed_value: str = "orig_mfe", value: str = "mfe",
              final_rows: int = FINAL_ROWS) -> DataFrame:
    """Background summary per observed row; ``observed`` has one row per key.

    The background is read once and its counted values are stored. Groups of up to ``final_rows``
    distinct values are summarised in one row; larger ones are first narrowed by counting.
    """
    key = list(key)
    counted = counted_values(background, key, value)
    sizes = counted.groupBy(*key).agg(F.count("*").alias("_rows"))
    large = F.col("_rows") > final_rows
    found = sizes.agg(F.max("_rows").alias("largest"), F.count(F.when(large, 1)).alias("groups")).first()
    if not found["groups"]:
        return summarise_counted(observed, counted, key, observed_value, value)
    hot = sizes.filter(large).select(*key)
    # So many keys were counted.
    hot = F.broadcast(hot) if found["groups"] <= keys.BROADCAST_ROWS else hot
    cold = summarise_counted(
        observed.join(hot, key, "left_anti"), counted.join(hot, key, "left_anti"),
        key, observed_value, value)
    many = summarise_by_counting(observed.join(hot, key, "left_semi"), counted.join(hot, key, "left_semi"), key,
                                 found["largest"], found["groups"], observed_value, value, final_rows)
    return cold.unionByName(many)


def score(summary: DataFrame, requested: str = "n_shuffles",
          observed_value: str = "orig_mfe") -> DataFrame:
    """Adds ``pvalue``, ``zscore``, ``n_missing`` and ``n_shuffles_requested``.

    A row for which no shuffles were requested keeps its energy and gets no score.
    """
    observed, median = F.col(observed_value), F.col("median_mfe")
    asked = F.col(requested) > 0
    return (summary
            .withColumn("median_mfe", F.when(asked, median))
            .withColumn("pvalue", F.when(asked, stats.empirical_p(
                observed, median, F.col("at_most"), F.col("n_valid"), F.col(requested))))
            .withColumn("zscore", F.when(asked, stats.robust_z(observed, median, F.col("mad"))))
            .withColumn("n_missing", F.when(asked, F.col(requested) - F.col("n_valid"))
                        .otherwise(F.lit(0)).cast("int"))
            .withColumn("n_valid", F.when(asked, F.col("n_valid")).otherwise(F.lit(0)).cast("int"))
            .withColumn("n_shuffles_requested", F.col(requested).cast("int")))


def with_error(scored: DataFrame, min_valid_percent: int = MIN_VALID_PERCENT,
               observed_value: str = "orig_mfe") -> DataFrame:
    """Adds ``error``: why a sequence has no usable score, or null."""
    needed = stats.required_valid(F.col("n_shuffles_requested"), min_valid_percent)
    too_few = F.concat(F.lit(f"{FEW_SHUFFLES} ("), F.col("n_valid").cast("string"),
                       F.lit("/"), F.col("n_shuffles_requested").cast("string"), F.lit(")"))
    return scored.withColumn(
        "error",
        F.when(F.col(observed_value).isNull(), F.lit(INVALID_ENERGY))
         .when((F.col("n_shuffles_requested") > 0) & (F.col("n_valid") < needed), too_few))
