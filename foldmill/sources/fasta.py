"""FASTA files.

Files of many short records are split at record starts. Files whose records are
chromosomes are read line by line, and a chromosome becomes many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from foldmill.functions.ids import normalise_id
from foldmill.functions.sequences import fasta_body, fasta_header, fasta_name
from foldmill.operators.extraction import with_cds_bounds
from foldmill.operators.keys import keep_last, measured
from foldmill.operators.splice import BIN_SIZE, cut_into_bins
from foldmill.session import settle
from foldmill.sources.text import ordered_lines, place_in_file


def parse_records(records: DataFrame, record: str = "value") -> DataFrame:
    """``name, header, seq`` of FASTA records; records without a name are dropped."""
    header = fasta_header(F.col(record))
    return (records.withColumn("header", header)
            .withColumn("name", fasta_name(F.col("header")))
            .withColumn("seq", fasta_body(F.col(record)))
            .filter(F.col("name") != "").drop(record))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``name, header, seq``, one row per record, for records of ordinary size.

    Partition columns of the path, such as ``region=...``, are kept.
    """
    return parse_records(spark.read.text(path, lineSep="\n>"))


def read_latest_records(spark: SparkSession, path: str) -> DataFrame:
    """Like :func:`read_records`, with one row per name: the last in the files."""
    rows = spark.read.text(path, lineSep="\n>").select("*", place_in_file().alias("pos"))
    return keep_last(parse_records(rows), ["name"], ["pos"]).drop("pos")


def read_mrna(spark: SparkSession, path: str) -> DataFrame:
    """Spliced transcripts whose headers carry ``CDS=<first>-<last>``."""
    return with_cds_bounds(read_records(spark, path)).withColumn(
        "tx_id", normalise_id(F.col("name")))


def read_genome(spark: SparkSession, path: str, bin_size: int = BIN_SIZE) -> DataFrame:
    """``seqid, bin, piece_start, seq``: a genome in pieces of at most ``bin_size``."""
    return genome_pieces(ordered_lines(spark, path), bin_size)


def genome_pieces(lines: DataFrame, bin_size: int = BIN_SIZE) -> DataFrame:
    """Genome pieces of FASTA lines with ``raw`` and ``pos``.

    Lines are joined to chunks within their input split. Within a split, part 0 is
    the rest of a record that began before it, and every header starts a new part.
    Only part 0 has to learn its record and place from the splits before it, which
    takes one small row per split.
    """
    raw = F.translate("raw", " \r", "")
    in_split = Window.partitionBy("file", "block").orderBy("line")
    part = Window.partitionBy("file", "block", "part")
    before = part.orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    header = F.col("raw").startswith(">")
    name = F.when(header, fasta_name(F.expr("substring(raw, 2)")))
    located = (lines.select("pos.file", "pos.block", "pos.line",
                            name.alias("header"), F.when(header, "").otherwise(raw).alias("bases"))
               .withColumn("part", F.count("header").over(in_split))
               .withColumn("name", F.max("header").over(part))
               .withColumn("offset", F.coalesce(F.sum(F.length("bases")).over(before), F.lit(0))))
    chunks = settle(
        located.groupBy("file", "block", "part", "name", F.floor(F.col("offset") / bin_size))
        .agg(F.min("offset").alias("offset"), _joined("line", "bases").alias("seq"))
        .select("file", "block", "part", "name", "offset", "seq", F.length("seq").alias("size")))
    first = F.col("part") == 0
    segments = chunks.join(measured(_carried(chunks)), ["file", "block"], "left").select(
        F.when(first, F.col("owner")).otherwise(F.col("name")).alias("seqid"),
        (F.when(first, F.coalesce("carried", F.lit(0))).otherwise(F.lit(0))
         + F.col("offset") + 1).alias("seq_start"), "seq")
    return cut_into_bins(segments.filter(F.col("seqid") != ""), bin_size)


def _joined(order: str, text: str) -> Column:
    rows = F.array_sort(F.collect_list(F.struct(order, text)))
    return F.array_join(F.transform(rows, lambda row: row[text]), "")


def _carried(chunks: DataFrame) -> DataFrame:
    """Per split: the record open at its start, and how much of it came before."""
    parts = chunks.groupBy("file", "block", "part", "name").agg(F.sum("size").alias("size"))
    last = F.max(F.struct("part", "name", "size"))
    splits = parts.groupBy("file", "block").agg(last.alias("last")).select(
        "file", "block", "last.name", "last.size")
    in_file = Window.partitionBy("file").orderBy("block")
    in_record = Window.partitionBy("file", "record").orderBy("block")
    return (splits.withColumn("record", F.count("name").over(in_file))
            .withColumn("name", F.first("name").over(in_record))
            .withColumn("so_far", F.sum("size").over(in_record))
            .select("file", "block", F.lag("name").over(in_file).alias("owner"),
                    F.lag("so_far").over(in_file).alias("carried")))
