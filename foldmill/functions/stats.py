"""The score formulas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foldmill.fixed_values import MAD_SCALE


def median_of_sorted(values: Column) -> Column:
    """Middle value of a sorted array, or the mean of its two middle values."""
    size = F.size(values)
    low = F.get(values, F.floor((size - 1) / 2).cast("int"))
    high = F.get(values, F.floor(size / 2).cast("int"))
    return F.when(size > 0, (low + high) / 2)


def robust_z(observed: Column, median: Column, mad: Column) -> Column:
    """Distance from the median in scaled MADs; null where the MAD is zero."""
    return F.when(mad != 0, (observed - median) / (mad * MAD_SCALE))


def empirical_p(observed: Column, median: Column, at_most: Column, valid: Column,
                requested: Column) -> Column:
    """One-sided lower-tail p-value with the add-one correction.

    Shuffles that gave no value count as at least as stable, but only when the
    observed energy is at or below the median.
    """
    lost = F.when(observed <= median, requested - valid).otherwise(F.lit(0))
    return F.when(median.isNotNull(), (at_most + lost + 1) / (requested + 1))


def required_valid(requested: Column, percent: int) -> Column:
    """Fewest valid shuffles that make a score."""
    return F.floor(requested * percent / 100).cast("int")


def weighted_median(pairs: Column, total: Column) -> Column:
    """Median of a sorted array of (value ``v``, weight ``w``) whose weights sum to ``total``."""
    return weighted_at(pairs, F.floor((total - 1) / 2), F.floor(total / 2))


def weighted_at(pairs: Column, low: Column, high: Column) -> Column:
    """Mean of the values at two places, from 0, of a sorted array of (value ``v``, weight ``w``).

    One walk along the array finds both.
    """
    none = F.lit(None).cast("double")
    start = F.struct(F.lit(0).cast("bigint").alias("n"), none.alias("a"), none.alias("b"))

    def step(done: Column, pair: Column) -> Column:
        after = done["n"] + pair["w"]

        def middle(place: Column, name: str) -> Column:
            here = (done["n"] <= place) & (place < after)
            return F.when(here, pair["v"].cast("double")).otherwise(done[name]).alias(name)

        return F.struct(after.alias("n"), middle(low, "a"), middle(high, "b"))

    return F.aggregate(pairs, start, step, lambda done: (done["a"] + done["b"]) / 2)
