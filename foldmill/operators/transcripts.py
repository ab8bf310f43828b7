"""Choosing one transcript per requested gene from annotation lines.

``lines`` always has ``raw``, the annotation line, and ``pos``, which orders the
lines as in the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.fixed_values import LONGEST_CDS, TRANSCRIPT_TYPES
from foldmill.functions import attributes as attrs
from foldmill.functions.ids import normalise_id, original_id
from foldmill.operators.keys import having_key, measured, top_rows


def requested_genes(raw_ids: DataFrame, column: str = "value") -> DataFrame:
    """Clean, distinct gene ids of a one-column list; blank lines are dropped."""
    text = F.regexp_replace(F.col(column), r"^\s+|\s+$", "")
    return (raw_ids.filter(text != "")
            .select(normalise_id(text).alias("gene_id")).distinct())


def feature_lines(lines: DataFrame, types: Sequence[str]) -> DataFrame:
    """Lines of the given feature types, comments left out."""
    raw = F.col("raw")
    return lines.filter(~attrs.is_comment(raw) & attrs.has_type(raw, types))


def transcript_lines(lines: DataFrame, tags: Sequence[str] = (),
                     anchored: bool = False) -> DataFrame:
    """Transcript lines as ``gene_id, tx_id, orig_tx_id, tags, tag_rank, pos``.

    Lines without a transcript id, or without a gene id or parent, are dropped.
    """
    raw = F.col("raw")
    return (feature_lines(lines, TRANSCRIPT_TYPES)
            .select(attrs.attribute(raw, "transcript_id", anchored).alias("_tx"),
                    attrs.first_attribute(raw, ["gene_id", "Parent"], anchored).alias("_gene"),
                    attrs.tags_held(raw, tags).alias("tags"),
                    attrs.tag_rank(raw, tags).alias("tag_rank"), "pos")
            .filter(F.col("_tx").isNotNull() & F.col("_gene").isNotNull())
            .select(normalise_id(F.col("_gene")).alias("gene_id"),
                    normalise_id(F.col("_tx")).alias("tx_id"),
                    original_id(F.col("_tx")).alias("orig_tx_id"),
                    "tags", "tag_rank", "pos"))


def with_parent(lines: DataFrame, anchored: bool = False) -> DataFrame:
    """Adds ``tx_id``, the line's parent, and ``orig_id``, the same with its version; lines without
    a parent are dropped.

    The unanchored reading takes the last id of a parent list, the anchored one
    gives a row per id.
    """
    parent = attrs.attribute(F.col("raw"), "Parent", anchored)
    return with_ids(lines.withColumn("_parent", parent), anchored)


def with_ids(lines: DataFrame, anchored: bool = False) -> DataFrame:
    """The same from the parents as written in ``_parent``."""
    owned = lines.withColumn("_parent", F.explode(F.split("_parent", ","))) if anchored else lines
    return (owned.filter(F.col("_parent").isNotNull())
            .withColumn("tx_id", normalise_id(F.col("_parent")))
            .withColumn("orig_id", original_id(F.col("_parent"))).drop("_parent"))


def coding_lengths(lines: DataFrame, valid: DataFrame, anchored: bool = False) -> DataFrame:
    """Total coding length of each transcript in ``valid`` that has coding lines."""
    first, last = (attrs.tab_field(F.col("raw"), n).try_cast("bigint") for n in (3, 4))
    span = last - first + 1
    return (with_parent(feature_lines(lines, ["CDS"]), anchored)
            .join(valid.select("tx_id"), "tx_id", "left_semi")
            .groupBy("tx_id").agg(F.sum(span).alias("cds_len")))


def candidates(lines: DataFrame, genes: DataFrame, tags: Sequence[str] = (),
               anchored: bool = False) -> DataFrame:
    """Transcripts of the requested genes with tag rank and coding length.

    A transcript id that occurs on several lines keeps the tags of its last line
    and its first place in the file.
    """
    listed = having_key(transcript_lines(lines, tags, anchored), genes, ["gene_id"])
    pairs = measured(listed.groupBy("gene_id", "tx_id").agg(
        F.min("pos").alias("pos"),
        F.max(F.struct("pos", "orig_tx_id", "tag_rank")).alias("line")))
    latest = (pairs.groupBy("tx_id").agg(F.max("line").alias("last"))
              .select("tx_id", "last.orig_tx_id", "last.tag_rank"))
    return (pairs.select("gene_id", "tx_id", "pos").join(latest, "tx_id")
            .join(coding_lengths(lines, pairs, anchored), "tx_id", "left")
            .withColumn("cds_len", F.coalesce("cds_len", F.lit(0))))


def best_per_gene(transcripts: DataFrame, tags: Sequence[str] = (),
                  gene: str = "gene_id", tie: Sequence[str | Column] = ("pos",)) -> DataFrame:
    """One transcript per gene, and why it was chosen.

    The best ``tag_rank`` wins, then the longest ``cds_len``, then the first in
    ``tie`` order. Without any tag the reason is the coding length.
    """
    order = [F.col("tag_rank").asc(), F.col("cds_len").desc(),
             *[F.col(t) if isinstance(t, str) else t for t in tie]]
    reasons = F.array(*map(F.lit, [*tags, LONGEST_CDS]))
    return (top_rows(transcripts, [gene], order)
            .withColumn("reason", F.get(reasons, F.col("tag_rank"))))


def select_transcripts(lines: DataFrame, genes: DataFrame, tags: Sequence[str] = (),
                       anchored: bool = False) -> DataFrame:
    """``gene_id, stripped_id, orig_id, reason``: the chosen transcript per gene."""
    chosen = best_per_gene(candidates(lines, genes, tags, anchored), tags)
    return chosen.select("gene_id", F.col("tx_id").alias("stripped_id"),
                         F.col("orig_tx_id").alias("orig_id"), "reason")


def selected_lines(lines: DataFrame, selected: DataFrame, anchored: bool = False) -> DataFrame:
    """Annotation lines that belong to a chosen transcript."""
    owner = normalise_id(attrs.leftmost_attribute(
        F.col("raw"), ["transcript_id", "Parent"], anchored))
    owned = (lines.filter(~attrs.is_comment(F.col("raw")))
             .withColumn("stripped_id", owner).filter(F.col("stripped_id").isNotNull()))
    return having_key(owned, selected, ["stripped_id"])
