"""Set-like operators on keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldmill.session import settle

# A key or summary table within these bounds is broadcast; beyond, Spark shuffles.
BROADCAST_ROWS = 200_000
BROADCAST_TEXT_BYTES = 64_000_000


def key_set(df: DataFrame, *columns: str | Column) -> DataFrame:
    """Distinct keys. Partial aggregation shrinks a hot key before the shuffle."""
    return df.select(*columns).distinct()


def is_small(stored: DataFrame) -> bool:
    """Whether a stored narrow table has few enough rows and text to be broadcast."""
    text = [F.coalesce(F.octet_length(name), F.lit(0)) for name, kind in stored.dtypes
            if kind == "string"]
    size = stored.agg(F.count("*").alias("rows"),
                      F.coalesce(F.sum(sum(text, F.lit(0))), F.lit(0)).alias("text")).first()
    return size["rows"] <= BROADCAST_ROWS and size["text"] <= BROADCAST_TEXT_BYTES


def measured(df: DataFrame) -> DataFrame:
    """Computes a narrow table once, and marks it for broadcast if it is small.

    The table is settled, so readers share one result and its measured size.
    """
    small, stored = _weighed(df)
    return F.broadcast(stored) if small else stored


def measured_if_small(df: DataFrame) -> DataFrame | None:
    """The same, but nothing where the table is too large for a broadcast."""
    small, stored = _weighed(df)
    return F.broadcast(stored) if small else None


def _weighed(df: DataFrame) -> tuple[bool, DataFrame]:
    stored = settle(df)
    return is_small(stored), stored


def having_key(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``."""
    return df.join(key_set(keys, *on), list(on), "left_semi")


def lacking_key(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys``."""
    return df.join(key_set(keys, *on), list(on), "left_anti")


def top_rows(df: DataFrame, group: Sequence[str], order: Sequence[Column],
             count: int = 1) -> DataFrame:
    """First ``count`` rows of each group.

    The rank filter lets Spark cut every group to ``count`` rows on the map side
    (WindowGroupLimit), so a hot group never reaches one task whole.
    """
    ranked = df.withColumn("_rank", F.row_number().over(
        Window.partitionBy(*group).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= count).drop("_rank")


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the last one in ``order``."""
    descending = [F.col(c).desc() if isinstance(c, str) else c.desc() for c in order]
    return top_rows(df, key, descending)
