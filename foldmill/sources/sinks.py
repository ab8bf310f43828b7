"""Writers. Tables are written as folders of part files, one writer per task."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, functions as F

from foldmill.functions.sequences import fasta_text
from foldmill.operators.collate import printed
from foldmill.session import folder_exists, remove_folder

log = logging.getLogger(__name__)


def write_table(df: DataFrame, path: str, sep: str = "\t", header: bool = True,
                crlf: bool = True, mode: str = "overwrite") -> None:
    """Delimited text; nulls and empty text are both written as nothing."""
    df.write.mode(mode).options(
        sep=sep, header=header, nullValue="", emptyValue="", quote='"', escape='"',
        lineSep="\r\n" if crlf else "\n").csv(path)


def write_counted(df: DataFrame, path: str, **options) -> int:
    """Writes delimited text and returns the number of rows, which are counted as they are written.

    Without rows there is no table at ``path`` afterwards, but one from an earlier run stays, emptied.
    """
    new = not folder_exists(df.sparkSession, path)
    counted = Observation()
    write_table(df.observe(counted, F.count(F.lit(1)).alias("rows")), path, **options)
    rows = counted.get["rows"]
    if not rows and new:
        remove_folder(df.sparkSession, path)
    return rows


def write_manifest(manifest: DataFrame, path: str) -> int:
    """Writes the manifest and returns its number of rows."""
    rows = write_counted(manifest, path)
    if not rows:
        log.warning("The manifest has no rows.")
    return rows


def write_summary(summary: DataFrame, path: str) -> None:
    write_table(summary, path, sep=",")


def write_results(results: DataFrame, path: str) -> None:
    """Result rows as comma-separated text with four decimals and ``NA``."""
    write_table(printed(results), path, sep=",", crlf=False)


def write_raw_shuffles(raw: DataFrame, path: str) -> None:
    write_table(raw, path, sep=",", crlf=False)


def write_collated(collated: DataFrame, path: str, order: Iterable[str] = (),
                   drop: Iterable[str] = ()) -> int:
    """Writes a collated result table as printed text in ``order`` and returns its number of rows.

    ``drop`` names columns that are only for the order. Rows are counted behind the sort, which
    reads its input twice.
    """
    rows = collated.orderBy(*order) if order else collated
    return write_counted(printed(rows.drop(*drop)), path)


def write_fasta(regions: DataFrame, path: str, requested: Iterable[str] = (),
                mode: str = "overwrite") -> None:
    """One FASTA folder per region, ``path/region=<name>``.

    Every requested region gets a folder, also one without records.
    """
    text = regions.select("region", fasta_text(F.col("seqname"), F.col("seq")).alias("value"))
    text.write.mode(mode).partitionBy("region").text(path)
    spark = regions.sparkSession
    empty = set(requested) - {r.region for r in regions.select("region").distinct().collect()}
    for region in sorted(empty):
        spark.createDataFrame([], "value string").write.mode("overwrite").text(
            f"{path}/region={region}")


def write_single_records(regions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One folder per sequence. For looking at a few records, not for whole runs."""
    (regions.select("seqname", fasta_text(F.col("seqname"), F.col("seq")).alias("value"))
     .write.mode(mode).partitionBy("seqname").text(path))


def write_tiers(tiered: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tiered sequences, partitioned by tier so a tier is read alone."""
    tiered.write.mode(mode).partitionBy("tier").parquet(path)


def write_lengths(tiered: DataFrame, path: str) -> None:
    write_table(tiered.select("length", "seqname", "tier"), path, header=False, crlf=False)


def write_lines(df: DataFrame, lines: list[str], path: str) -> None:
    """A few lines of text next to the data they describe."""
    df.sparkSession.createDataFrame([("\n".join(lines),)], "value string").coalesce(1) \
        .write.mode("overwrite").text(path)
