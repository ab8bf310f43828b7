"""Durations and resource units."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def elapsed_seconds(text: Column) -> Column:
    """Seconds of ``h:m:s``, ``m:s`` or ``s``; null for any other field count."""
    parts = F.split(text, ":")
    weights = {1: (1,), 2: (60, 1), 3: (3600, 60, 1)}
    seconds = F.lit(None).cast("double")
    for count, factors in weights.items():
        total = sum((F.get(parts, F.lit(i)).try_cast("double") * factor
                     for i, factor in enumerate(factors)), F.lit(0.0))
        seconds = F.when(F.size(parts) == count, total).otherwise(seconds)
    return seconds


def clock_minutes(seconds: Column) -> Column:
    """``HH:MM:SS`` after rounding whole seconds up to a full minute."""
    minutes = F.ceil(seconds / 60).cast("bigint")
    return F.when(minutes.isNotNull(), F.format_string(
        "%02d:%02d:00", F.floor(minutes / 60), minutes % 60))


def whole_seconds(seconds: Column) -> Column:
    """Nearest whole second, halves up."""
    return F.floor(seconds + 0.5).cast("int")


def kb_to_mb(kilobytes: Column) -> Column:
    return F.floor(kilobytes / 1024).cast("int")
