"""From genome, annotation and gene list to regions, manifest and quality report."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.config import ExtractConfig
from foldmill.functions.ids import original_id
from foldmill.operators import extraction, splice, transcripts
from foldmill.operators.keys import having_key
from foldmill.plans import provenance
from foldmill.sources import fasta, gff, sinks
from foldmill.sources.text import read_gene_list

log = logging.getLogger(__name__)


def spliced_transcripts(lines: DataFrame, pieces: DataFrame, selected: DataFrame,
                        anchored: bool = False, bin_size: int = splice.BIN_SIZE) -> DataFrame:
    """Spliced sequences of the chosen transcripts."""
    wanted = selected.select(F.col("stripped_id").alias("tx_id"))
    own = having_key(splice.features(lines, anchored), wanted, ["tx_id"])
    return splice.splice(splice.transcript_models(own), pieces, bin_size)


def run_extraction(spark: SparkSession, config: ExtractConfig, force: bool = False,
                   anchored: bool = False, mrna_fasta: str | None = None) -> DataFrame | None:
    """Writes all extraction outputs and returns the status counts.

    Returns None when the outputs are current and ``force`` is not set.
    ``mrna_fasta`` names already spliced transcripts to use instead of splicing.
    """
    out = config.output_dir
    mark = provenance.fingerprint(spark, config)
    if not force and provenance.is_current(spark, config, mark):
        log.info("Outputs in '%s' are current.", out)
        return None
    if not config.isoform_priority:
        log.warning("isoform_priority is empty: transcripts are chosen by coding length alone.")

    genes = read_gene_list(spark, config.gene_list)
    lines = _stage(gff.read_annotation(spark, config.annotation_gff), f"{out}/stage/annotation")
    selected = _stage(transcripts.select_transcripts(lines, genes, config.isoform_priority, anchored),
                      f"{out}/stage/selected")
    if mrna_fasta:
        mrna = fasta.read_mrna(spark, mrna_fasta).select(
            "tx_id", original_id(F.col("name")).alias("orig_id"), "seq", "cds_start", "cds_end")
    else:
        # The lines of the chosen transcripts, a small part of the annotation, are all that is spliced.
        own = _stage(transcripts.selected_lines(lines, selected, anchored).select("raw", "pos"),
                     f"{out}/stage/annotation_selected")
        mrna = spliced_transcripts(own, fasta.read_genome(spark, config.genome_fasta),
                                   selected, anchored)
    records = _stage(extraction.with_status(extraction.attach_selection(mrna, selected),
                                            config.min_utr_length), f"{out}/stage/records")
    kept = extraction.writable(records, config.filter_short_utrs)
    if config.regions_to_extract:
        cut = extraction.cut_regions(kept, config.regions_to_extract,
                                     config.codon_flank_length, config.tail_length)
        cut.write.mode("overwrite").partitionBy("region").parquet(f"{out}/regions")
        regions = spark.read.schema(cut.schema).parquet(f"{out}/regions")
        if config.output_mode == "multifasta":
            sinks.write_fasta(regions, f"{out}/fasta", config.regions_to_extract)
        else:
            sinks.write_single_records(regions, f"{out}/fasta")
        sinks.write_manifest(extraction.manifest(regions), f"{out}/manifest.tsv")
    else:
        log.warning("regions_to_extract is empty: nothing is cut.")
        # Outputs of an earlier run must not pass for those of this one.
        none = extraction.cut_regions(kept.limit(0))
        none.write.mode("overwrite").parquet(f"{out}/regions")
        sinks.write_manifest(extraction.manifest(none), f"{out}/manifest.tsv")
    summary = extraction.summary(records, genes, selected)
    sinks.write_summary(summary, f"{out}/extraction_summary.csv")
    provenance.write_run_manifest(spark, config, genes.count(), mark)
    return extraction.status_counts(summary)


def _stage(df: DataFrame, path: str) -> DataFrame:
    """Writes an intermediate table and reads it back, so it is computed once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
