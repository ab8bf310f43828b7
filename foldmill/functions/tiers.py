"""Length tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from foldmill.fixed_values import TIER_BOUNDS, TIER_SHUFFLES


def check_policy(bounds: Sequence[int], shuffles: Sequence[int]) -> None:
    if len(bounds) != 9:
        raise ValueError(f"{len(bounds)} tier bounds given, ten tiers need nine")
    if list(bounds) != sorted(bounds):
        raise ValueError("tier bounds must ascend")
    if len(shuffles) != 10:
        raise ValueError(f"{len(shuffles)} shuffle counts given for ten tiers")


def tier_of(length: Column, bounds: Sequence[int] = TIER_BOUNDS) -> Column:
    """Tier number, 1-based: one more than the number of bounds reached."""
    check_policy(bounds, TIER_SHUFFLES)
    tier = F.lit(1)
    for bound in bounds:
        tier = tier + (length >= bound).cast("int")
    return tier.cast("int")


def tier_range(tier: Column, bounds: Sequence[int] = TIER_BOUNDS) -> Column:
    """Printed length range of a tier."""
    lower = [0, *bounds]
    labels = [f"{low}-{high}" for low, high in zip(lower, bounds)] + [f">{bounds[-1]}"]
    return F.try_element_at(F.array(*map(F.lit, labels)), tier.cast("int"))


def tier_shuffles(tier: Column, shuffles: Sequence[int] = TIER_SHUFFLES) -> Column:
    """Number of shuffles the policy gives a tier."""
    return F.try_element_at(F.array(*map(F.lit, shuffles)), tier.cast("int"))
