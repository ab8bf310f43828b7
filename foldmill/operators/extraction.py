"""Regions, manifest and quality report of spliced transcripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.fixed_values import (
    CODON_FLANK_LENGTH, MIN_UTR_LENGTH, REASON_NOT_FOUND, REGIONS, STATUS_MISSING,
    STATUS_NO_CDS, STATUS_NOT_IN_FASTA, STATUS_SHORT, STATUS_SUCCESS, SUMMARY_COLUMNS,
    TAIL_LENGTH)
from foldmill.functions.ids import seqname
from foldmill.functions.sequences import cds_bounds, region_slice
from foldmill.operators.keys import top_rows


def with_cds_bounds(records: DataFrame, header: str = "header") -> DataFrame:
    """Adds ``cds_start`` and ``cds_end`` read from each record's header."""
    start, end = cds_bounds(F.col(header))
    return records.withColumn("cds_start", start).withColumn("cds_end", end)


def attach_selection(mrna: DataFrame, selected: DataFrame) -> DataFrame:
    """Spliced transcripts of the chosen ids.

    Two genes that chose the same id share one record; it goes to the last gene. Of several
    records of one bare id, the one written like the chosen id stays, else the last by name and text.
    """
    owner = top_rows(selected, ["stripped_id"], [F.col("gene_id").desc()])
    written = mrna["orig_id"] if "orig_id" in mrna.columns else F.lit(None).cast("string")
    found = mrna.withColumn("_written", written).drop("orig_id").join(
        owner, mrna["tx_id"] == owner["stripped_id"])
    best = [F.coalesce(F.col("_written") == F.col("orig_id"), F.lit(False)).desc(),
            F.col("_written").desc_nulls_last(), F.col("seq").desc()]
    return top_rows(found, ["stripped_id"], best).drop("stripped_id", "_written")


def with_status(records: DataFrame, min_utr: int = MIN_UTR_LENGTH) -> DataFrame:
    """Adds region lengths, the short-UTR flag and the status of each record."""
    start, end, size = F.col("cds_start"), F.col("cds_end"), F.length("seq")
    no_cds = start.isNull() | end.isNull()

    def known(length: Column) -> Column:
        return F.when(no_cds, F.lit(0)).otherwise(length)

    return (records
            .withColumn("total_length", size)
            .withColumn("utr5_length", known(start - 1))
            .withColumn("utr3_length", known(size - end))
            .withColumn("cds_length", known(end - start + 1))
            .withColumn("short_utrs", ~no_cds & ((F.col("utr5_length") < min_utr)
                                                 | (F.col("utr3_length") < min_utr)))
            .withColumn("status", F.when(no_cds, STATUS_NO_CDS)
                        .when(F.col("short_utrs"), STATUS_SHORT)
                        .otherwise(STATUS_SUCCESS)))


def writable(records: DataFrame, filter_short_utrs: bool = False) -> DataFrame:
    """Records whose regions are written out."""
    kept = records.filter(F.col("status") != STATUS_NO_CDS)
    return kept.filter(~F.col("short_utrs")) if filter_short_utrs else kept


def cut_regions(records: DataFrame, regions: Sequence[str] = REGIONS,
                flank: int = CODON_FLANK_LENGTH, tail: int = TAIL_LENGTH) -> DataFrame:
    """One row per record and requested region; empty regions are dropped.

    Only the requested regions are cut.
    """
    unknown = sorted(set(regions) - set(REGIONS))
    wanted = [r for r in REGIONS if r in regions]
    if unknown or not wanted:
        raise ValueError(f"regions must name some of {REGIONS}, got {list(regions)}")
    slices = F.array(*[
        F.struct(F.lit(region).alias("region"),
                 region_slice(region, F.col("seq"), F.col("cds_start"), F.col("cds_end"),
                              flank, tail).alias("bases"))
        for region in wanted])
    return (records.withColumn("_slice", F.explode(slices))
            .filter(F.length("_slice.bases") > 0)
            .withColumn("region", F.col("_slice.region"))
            .withColumn("seq", F.col("_slice.bases"))
            .withColumn("length", F.length("seq"))
            .withColumn("seqname", seqname(F.col("gene_id"), F.col("orig_id"), F.col("region")))
            .drop("_slice"))


def manifest(regions: DataFrame) -> DataFrame:
    """The metadata table of the cut regions."""
    return regions.select("seqname", "gene_id", F.col("orig_id").alias("transcript_id"),
                          "region", "length", F.col("reason").alias("selection_reason"),
                          "short_utrs")


def summary(records: DataFrame, genes: DataFrame, selected: DataFrame) -> DataFrame:
    """Quality report: records, requested genes not found, chosen genes not spliced.

    ``selected`` and ``records`` have at most one row per gene. Each table is read once: all rows
    are put under their gene, which then has a record, or else a choice, or else is missing.
    """
    lengths = ("total_length", "cds_length", "utr5_length", "utr3_length")
    fields = ("orig_id:string", "reason:string", *(f"{c}:int" for c in lengths), "status:string")
    row_type = f"struct<{','.join(fields)}>"
    none = [F.lit(0).alias(c) for c in lengths]

    def told(df: DataFrame, name: str, *columns) -> DataFrame:
        row = F.struct(*columns).cast(row_type)
        return df.select("gene_id", *(
            (row if n == name else F.lit(None).cast(row_type)).alias(n) for n in ("record", "choice", "request")))

    rows = (told(records, "record", "orig_id", "reason", *lengths, "status")
            .unionByName(told(selected, "choice", "orig_id", "reason", *none, F.lit(STATUS_NOT_IN_FASTA).alias("status")))
            .unionByName(told(genes, "request", F.lit("None").alias("orig_id"), F.lit(REASON_NOT_FOUND).alias("reason"),
                              *none, F.lit(STATUS_MISSING).alias("status"))))
    first = F.coalesce("record", "choice", "request")
    return (rows.groupBy("gene_id").agg(*(F.max(n).alias(n) for n in ("record", "choice", "request")))
            .select("gene_id", first.alias("row")).select("gene_id", "row.*").toDF(*SUMMARY_COLUMNS))


def status_counts(summary_df: DataFrame, status: str = "Status") -> DataFrame:
    """Rows per status, in status order."""
    return summary_df.groupBy(status).agg(F.count("*").alias("count")).orderBy(status)
