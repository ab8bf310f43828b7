"""Combining result tables with the manifest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.fixed_values import MANIFEST_COLUMNS, RAW_MANIFEST_COLUMNS
from foldmill.functions.energies import fixed4_or_na
from foldmill.operators.keys import keep_last


def latest_manifest(manifest: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """One manifest row per sequence: the last one in ``order``."""
    return keep_last(manifest, ["seqname"], order)


def collate_results(results: DataFrame, manifest: DataFrame | None) -> DataFrame:
    """Every result row with its manifest columns, null where there are none.

    ``manifest`` has one row per ``seqname``; ``None`` leaves all of its columns
    null. Result columns beyond the name are passed through as they are.
    """
    measures = [c for c in results.columns if c != "seq_name"]
    named = results.withColumnRenamed("seq_name", "seqname")
    return _attach(named, manifest, MANIFEST_COLUMNS, measures)


def collate_raw(raw: DataFrame, manifest: DataFrame | None, carry: Sequence[str] = ()) -> DataFrame:
    """Every shuffle row with its manifest columns; ``carry`` names further columns to keep.

    The ``transcript_id`` of a shuffle row holds the sequence name.
    """
    named = raw.withColumnRenamed("transcript_id", "seqname")
    return _attach(named, manifest, RAW_MANIFEST_COLUMNS, ["iteration", "shuffled_mfe", *carry])


def _attach(rows: DataFrame, manifest: DataFrame | None, metadata: Sequence[str],
            measures: Sequence[str]) -> DataFrame:
    if manifest is None:
        joined = rows.withColumns({c: F.lit(None).cast("string") for c in metadata})
    else:
        joined = rows.join(manifest.select("seqname", *metadata), "seqname", "left")
    return joined.select("seqname", *metadata, *measures)


def join_metrics(manifest: DataFrame, metrics: Sequence[DataFrame]) -> DataFrame:
    """Manifest with the columns of every metric table, joined on ``seqname``.

    Metadata a metric table repeats is dropped before the join.
    """
    def add(left: DataFrame, right: DataFrame) -> DataFrame:
        new = [c for c in right.columns if c == "seqname" or c not in left.columns]
        return left.join(right.select(*new), "seqname", "left")

    return reduce(add, metrics, manifest)


def printed(collated: DataFrame) -> DataFrame:
    """Collated results as they are printed: four decimals, ``NA`` and empty text."""
    scores = {"orig_mfe", "median_mfe", "pvalue", "zscore"}
    return collated.select(*[
        (fixed4_or_na(F.col(c)) if c in scores
         else F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c)
        for c in collated.columns])
