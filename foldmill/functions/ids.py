"""Identifier clean-up."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def normalise_id(raw: Column) -> Column:
    """Bare identifier: namespace prefix and version suffix removed."""
    return F.substring_index(F.substring_index(raw, ":", -1), ".", 1)


def original_id(raw: Column) -> Column:
    """Identifier without its namespace prefix, version kept."""
    return F.substring_index(raw, ":", -1)


def seqname(*parts: Column) -> Column:
    """Sequence name: the parts joined by underscores."""
    return F.concat_ws("_", *parts)


def file_key(file_name: Column, suffix: str) -> Column:
    """Base name of a path without ``suffix``."""
    base = F.substring_index(file_name, "/", -1)
    stem = F.substring(base, F.lit(1), F.length(base) - len(suffix))
    return F.when(base.endswith(suffix), stem).otherwise(base)
