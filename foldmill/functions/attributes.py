"""Attribute access on annotation lines.

``anchored=False`` finds the key anywhere in the text it is given, which is how
the published pipeline reads annotation lines. ``anchored=True`` accepts a key
only at the start of an attribute.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from foldmill.fixed_values import VALUE_PATTERN


def _first_group(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def attribute(text: Column, key: str, anchored: bool = False) -> Column:
    """Value of ``key``, or null where the text has none."""
    before = r"(?:^|[;\t])\s*" if anchored else ""
    return _first_group(text, before + re.escape(key) + "=" + VALUE_PATTERN)


def first_attribute(text: Column, keys: Sequence[str], anchored: bool = False) -> Column:
    """Value of the first key of ``keys`` that the text has."""
    return F.coalesce(*[attribute(text, key, anchored) for key in keys])


def leftmost_attribute(text: Column, keys: Sequence[str], anchored: bool = False) -> Column:
    """Value of whichever of ``keys`` stands furthest left in the text."""
    before = r"(?:^|[;\t])\s*" if anchored else ""
    choice = "|".join(re.escape(key) + "=" for key in keys)
    return _first_group(text, f"{before}(?:{choice}){VALUE_PATTERN}")


def has_tag(text: Column, tag: str) -> Column:
    """Whether ``tag`` occurs as a whole word."""
    return text.rlike(r"\b" + re.escape(tag) + r"\b")


def tags_held(text: Column, tags: Sequence[str]) -> Column:
    """The tags of ``tags`` that the text holds, in the order given."""
    if not tags:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[F.when(has_tag(text, tag), F.lit(tag)) for tag in tags]))


def tag_rank(text: Column, tags: Sequence[str]) -> Column:
    """Position of the first tag of ``tags`` the text holds; ``len(tags)`` if none."""
    held = [F.when(has_tag(text, tag), F.lit(rank)) for rank, tag in enumerate(tags)]
    return F.coalesce(*held, F.lit(len(tags)))


def is_comment(line: Column) -> Column:
    return line.startswith("#")


def has_type(line: Column, types: Sequence[str]) -> Column:
    """Whether the line has one of ``types`` as a tab-delimited field."""
    found = F.lit(False)
    for name in types:
        found = found | line.contains(f"\t{name}\t")
    return found


def tab_field(line: Column, number: int) -> Column:
    """The 0-based tab-delimited field of a line that has at least that many."""
    return F.substring_index(F.substring_index(line, "\t", number + 1), "\t", -1)
