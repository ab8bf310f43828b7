"""Finding the sequences that still have to be scored."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from foldmill.functions.ids import file_key
from foldmill.operators.keys import lacking_key


def completed(results: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Names that need no further run: those with a result row.

    With ``errors``, sequences that failed before count as done too.
    """
    done = results.select(F.col("seq_name").alias("seqname"))
    if errors is not None:
        done = done.unionByName(errors.select("seqname"))
    return done.distinct()


def completed_files(files: DataFrame) -> DataFrame:
    """Names whose result file has a header and a row.

    ``files`` has ``path`` and ``content``, one row per result file. A file counts
    by its line ends, so a row cut off before its line end is not complete.
    """
    line_ends = F.length("content") - F.length(F.translate("content", "\n", ""))
    name = F.regexp_replace(file_key(F.col("path"), ".csv"), "^results_", "")
    return files.filter(line_ends >= 2).select(name.alias("seqname")).distinct()


def unfinished(sequences: DataFrame, done: DataFrame,
               tiers: Iterable[int] | None = None) -> DataFrame:
    """Sequences, of all tiers or of ``tiers``, that are not done."""
    if tiers is not None:
        sequences = sequences.filter(F.col("tier").isin(*tiers))
    return lacking_key(sequences, done, ["seqname"])
