"""Sequence expressions: complement, slices and record parsing."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from foldmill.fixed_values import CDS_PATTERN

# IUPAC nucleotide codes and their complements, case kept.
IUPAC = "ACGTURYKMBVDHacgturykmbvdh"
IUPAC_COMPLEMENT = "TGCAAYRMKVBHDtgcaayrmkvbhd"


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, IUPAC, IUPAC_COMPLEMENT))


def cds_bounds(header: Column) -> tuple[Column, Column]:
    """First and last coding position of a header, 1-based and inclusive.

    Both are null where the header names no coding range.
    """
    return tuple(F.nullif(F.regexp_extract(header, CDS_PATTERN, group), F.lit(""))
                 .try_cast("int") for group in (1, 2))


def region_slice(region: str, seq: Column, cds_start: Column, cds_end: Column,
                 flank: int, tail: int) -> Column:
    """The named region of a spliced transcript.

    ``cds_start`` and ``cds_end`` are 1-based and inclusive.
    """
    size = F.length(seq)

    def between(first: Column, last: Column) -> Column:
        first = F.greatest(first, F.lit(1))
        last = F.least(last, size)
        return F.substring(seq, first, F.greatest(last - first + 1, F.lit(0)))

    if region == "mRNA":
        return seq
    if region == "CDS":
        return between(cds_start, cds_end)
    if region == "5UTR":
        return between(F.lit(1), cds_start - 1)
    if region == "3UTR":
        return between(cds_end + 1, size)
    if region == "start_codon_region":
        return between(cds_start - flank, cds_start + 2 + flank)
    if region == "stop_codon_region":
        return between(cds_end - 2 - flank, cds_end + flank)
    if region == "tail_region":
        return between(size - tail + 1, size) if tail else seq
    raise ValueError(f"unknown region {region!r}")


def fasta_header(record: Column) -> Column:
    """Header line of a FASTA record, without ``>`` and line ends."""
    first_line = F.substring_index(record, "\n", 1)
    return F.regexp_replace(F.translate(first_line, "\r", ""), "^>", "")


def fasta_name(header: Column) -> Column:
    """First word of a header."""
    return F.regexp_extract(header, r"^(\S*)", 1)


def fasta_body(record: Column) -> Column:
    """Sequence of a FASTA record with its line breaks removed."""
    first_line = F.substring_index(record, "\n", 1)
    return F.translate(F.substring(record, F.length(first_line) + 2, F.length(record)),
                       " \t\r\n", "")


def fasta_text(name: Column, seq: Column) -> Column:
    """A FASTA record: header line and one sequence line."""
    return F.concat(F.lit(">"), name, F.lit("\n"), seq)
