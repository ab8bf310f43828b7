"""Regions, manifest, quality report, splicing. Documents stand for transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldmill.fixed_values import REGIONS
from foldmill.operators import extraction, splice
from foldmill.operators.keys import lacking_key
from foldmill.session import settle
from foldmill.workload.registry import query, table

# Coding range of a document: its middle half. Every seventh has none.
_HEADER = """'D' || doc_id || ' lang=' || lang || CASE WHEN doc_id % 7 = 3 THEN ''
  ELSE ' CDS=' || (n_chars // 4 + 1) || '-' || (n_chars - n_chars // 4) END"""

_RECORDS = f"""
head AS (SELECT doc_id, text AS seq, {_HEADER} AS header FROM documents),
rec AS (
  SELECT doc_id, 'G' || doc_id AS gene_id, 'T' || doc_id || '.1' AS orig_id,
    CASE WHEN doc_id % 2 = 0 THEN 'MANE_Select' ELSE 'longest_cds' END AS reason, seq,
    CAST(length(seq) AS INTEGER) AS total_length,
    CAST(nullif(regexp_extract(header, 'CDS=(\\d+)-(\\d+)', 1), '') AS INTEGER) AS s,
    CAST(nullif(regexp_extract(header, 'CDS=(\\d+)-(\\d+)', 2), '') AS INTEGER) AS e
  FROM head),
checked AS (
  SELECT *, coalesce(s - 1, 0) AS utr5, coalesce(total_length - e, 0) AS utr3,
    coalesce(e - s + 1, 0) AS cds,
    s IS NOT NULL AND (s - 1 < 30 OR total_length - e < 30) AS short_utrs,
    CASE WHEN s IS NULL THEN 'No_CDS'
         WHEN s - 1 < 30 OR total_length - e < 30 THEN 'Short_or_Missing_UTRs'
         ELSE 'Success' END AS status
  FROM rec),
slices AS (
  SELECT *, 'mRNA' AS region, seq AS part FROM checked
  UNION ALL SELECT *, 'CDS', substring(seq, s, e - s + 1) FROM checked
  UNION ALL SELECT *, '5UTR', substring(seq, 1, s - 1) FROM checked
  UNION ALL SELECT *, '3UTR', substring(seq, e + 1) FROM checked
  UNION ALL SELECT *, 'start_codon_region',
    substring(seq, greatest(1, s - 30), least(total_length, s + 32) - greatest(1, s - 30) + 1) FROM checked
  UNION ALL SELECT *, 'stop_codon_region',
    substring(seq, greatest(1, e - 32), least(total_length, e + 30) - greatest(1, e - 32) + 1) FROM checked
  UNION ALL SELECT *, 'tail_region',
    substring(seq, greatest(1, total_length - 99)) FROM checked),
regions AS (
  SELECT gene_id || '_' || orig_id || '_' || region AS seqname, gene_id, orig_id, region, reason,
    CAST(length(part) AS INTEGER) AS length, part, short_utrs
  FROM slices WHERE s IS NOT NULL AND part <> '')"""


def records(spark, sf_dir) -> DataFrame:
    """Documents as spliced transcripts with a parsed coding range and a status."""
    number = F.col("doc_id").cast("string")
    quarter = F.floor(F.col("n_chars") / 4)
    coding = F.concat(F.lit(" CDS="), (quarter + 1).cast("string"), F.lit("-"),
                      (F.col("n_chars") - quarter).cast("string"))
    headed = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("G"), number).alias("gene_id"),
        F.concat(F.lit("T"), number, F.lit(".1")).alias("orig_id"),
        F.when(F.col("doc_id") % 2 == 0, "MANE_Select").otherwise("longest_cds").alias("reason"),
        F.col("text").alias("seq"),
        F.concat(F.lit("D"), number, F.lit(" lang="), F.col("lang"),
                 F.when(F.col("doc_id") % 7 == 3, "").otherwise(coding)).alias("header"))
    return extraction.with_status(extraction.with_cds_bounds(headed))


@query(f"WITH {_RECORDS} SELECT doc_id, s AS cds_start, e AS cds_end FROM rec")
def cds_header_parse(spark, sf_dir):
    """Coding range read from headers, null where there is none."""
    return records(spark, sf_dir).select("doc_id", "cds_start", "cds_end")


@query(f"WITH {_RECORDS} SELECT seqname, region, length, md5(part) AS bases FROM regions")
def region_slices(spark, sf_dir):
    """The seven regions of every transcript, one row each."""
    kept = extraction.writable(records(spark, sf_dir))
    return extraction.cut_regions(kept).select(
        "seqname", "region", "length", F.md5("seq").alias("bases"))


@query(f"""WITH {_RECORDS}
SELECT seqname, gene_id, orig_id AS transcript_id, region, length, reason AS selection_reason,
  short_utrs FROM regions WHERE region IN ('CDS', '5UTR', 'tail_region')""")
def manifest_rows(spark, sf_dir):
    """Metadata of the requested regions."""
    kept = extraction.writable(records(spark, sf_dir))
    return extraction.manifest(extraction.cut_regions(kept, ["CDS", "5UTR", "tail_region"]))


@query(f"""WITH {_RECORDS}
SELECT doc_id, total_length, CAST(cds AS INTEGER) AS cds_length, CAST(utr5 AS INTEGER) AS utr5_length,
  CAST(utr3 AS INTEGER) AS utr3_length, short_utrs, status FROM checked""")
def short_utr_status(spark, sf_dir):
    """Region lengths, short-UTR flag and status."""
    return records(spark, sf_dir).select(
        "doc_id", "total_length", "cds_length", "utr5_length", "utr3_length", "short_utrs", "status")


@query(f"""WITH {_RECORDS}
SELECT region, count(*) AS n_regions, CAST(sum(length) AS BIGINT) AS n_bases
FROM regions WHERE NOT short_utrs GROUP BY region""")
def filtered_regions(spark, sf_dir):
    """Regions per name once short-UTR transcripts are dropped."""
    kept = extraction.writable(records(spark, sf_dir), filter_short_utrs=True)
    return extraction.cut_regions(kept, REGIONS).groupBy("region").agg(
        F.count("*").alias("n_regions"), F.sum("length").alias("n_bases"))


_SUMMARY = f"""{_RECORDS},
genes AS (SELECT 'G' || doc_id AS gene_id FROM documents
          UNION SELECT 'G' || (doc_id + 1000000000) FROM labels),
chosen AS (SELECT gene_id, orig_id, reason FROM rec WHERE doc_id % 11 <> 0),
spliced AS (SELECT * FROM checked WHERE doc_id % 11 <> 0 AND doc_id % 5 <> 0),
report AS (
  SELECT gene_id AS "Gene_ID", orig_id AS "Transcript_ID", reason AS "Selection_Reason",
    total_length AS "Total_Length", CAST(cds AS INTEGER) AS "CDS_Length",
    CAST(utr5 AS INTEGER) AS "5UTR_Length", CAST(utr3 AS INTEGER) AS "3UTR_Length",
    status AS "Status" FROM spliced
  UNION ALL SELECT gene_id, 'None', 'Not_Found_in_GFF', 0, 0, 0, 0, 'Missing' FROM genes
    WHERE gene_id NOT IN (SELECT gene_id FROM chosen)
  UNION ALL SELECT gene_id, orig_id, reason, 0, 0, 0, 0, 'No_CDS_in_FASTA' FROM chosen
    WHERE gene_id NOT IN (SELECT gene_id FROM spliced))"""


def _summary(spark, sf_dir) -> DataFrame:
    # Without the sequences, and stored, as the extraction step stores its records.
    everything = settle(records(spark, sf_dir).drop("seq"))
    selected = everything.filter(F.col("doc_id") % 11 != 0)
    genes = (everything.select("gene_id").union(table(spark, sf_dir, "labels").select(
        F.concat(F.lit("G"), (F.col("doc_id") + 1000000000).cast("string")))).distinct())
    return extraction.summary(selected.filter(F.col("doc_id") % 5 != 0), genes,
                              selected.select("gene_id", "orig_id", "reason"))


@query(f"WITH {_SUMMARY} SELECT * FROM report")
def extraction_summary(spark, sf_dir):
    """Quality report with genes that were not found or not spliced."""
    return _summary(spark, sf_dir)


@query(f"""WITH {_SUMMARY} SELECT "Status", count(*) AS count FROM report GROUP BY "Status" """)
def status_breakdown(spark, sf_dir):
    """Rows per status in status order (A5 O3)."""
    return extraction.status_counts(_summary(spark, sf_dir))


@query("""
SELECT c_custkey FROM customer WHERE c_custkey NOT IN (
  SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')""")
def missing_entities(spark, sf_dir):
    """Requested keys that never occur among those of a feature."""
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    urgent = (table(spark, sf_dir, "orders")
              .filter("o_orderpriority = '1-URGENT' and o_orderstatus = 'F'")
              .select(F.col("o_custkey").alias("c_custkey")))
    return lacking_key(customers, urgent, ["c_custkey"])


@query("""
WITH selected AS (SELECT o_custkey, max(o_orderkey) AS tx FROM orders GROUP BY o_custkey),
shared AS (SELECT CAST(tx // 3 AS BIGINT) AS tx, max(o_custkey) AS o_custkey FROM selected GROUP BY tx // 3),
records AS (SELECT DISTINCT o_orderkey // 3 AS tx FROM orders WHERE o_orderkey % 5 <> 2)
SELECT shared.tx, o_custkey FROM shared JOIN records ON shared.tx = records.tx""")
def attach_selection(spark, sf_dir):
    """Records of the chosen ids; of genes that chose one id the last has the record."""
    orders = table(spark, sf_dir, "orders")
    bare = F.floor(F.col("tx") / 3)
    gene = F.lpad(F.col("o_custkey").cast("string"), 12, "0")
    selected = (orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("tx"))
                .select(gene.alias("gene_id"), F.concat(F.lit("T"), bare).alias("stripped_id"),
                        F.concat(F.lit("T"), bare, F.lit(".1")).alias("orig_id")))
    records = orders.filter("o_orderkey % 5 <> 2").select(
        F.concat(F.lit("T"), F.floor(F.col("o_orderkey") / 3)).alias("tx_id"),
        F.concat(F.lit("T"), F.floor(F.col("o_orderkey") / 3), F.lit("."),
                 F.col("o_orderkey") % 3).alias("orig_id"), F.col("o_orderpriority").alias("seq"))
    found = extraction.attach_selection(records, selected)
    return found.select(F.substring("tx_id", 2, 20).cast("bigint").alias("tx"),
                        F.col("gene_id").cast("bigint").alias("o_custkey"))


# Exons of a document: 25 of every 40 letters. The second to the fifth are coding.
_EXONS = """
exons AS (SELECT doc_id, i, i * 40 + 1 + doc_id % 7 AS s, i * 40 + 25 + doc_id % 7 AS e
          FROM documents, unnest(generate_series(CAST(0 AS BIGINT), n_chars // 40 - 1)) AS g(i)
          WHERE i * 40 + 25 + doc_id % 7 <= n_chars),
spliced AS (
  SELECT exons.doc_id, string_agg(substring(text, s, 25), '' ORDER BY s) AS plus,
    count(*) AS n, max(i) AS last
  FROM exons JOIN documents ON exons.doc_id = documents.doc_id GROUP BY exons.doc_id),
stranded AS (
  SELECT doc_id, n, CASE WHEN doc_id % 2 = 0 THEN plus ELSE reverse(translate(plus,
    'ACGTURYKMBVDHacgturykmbvdh', 'TGCAAYRMKVBHDtgcaayrmkvbhd')) END AS seq,
    CASE WHEN n > 1 THEN 26 END AS f, CASE WHEN n > 1 THEN least(n, 5) * 25 END AS l
  FROM spliced)"""


@query(f"""WITH {_EXONS}
SELECT 'T' || doc_id AS tx_id, md5(seq) AS bases,
  CAST(CASE WHEN doc_id % 2 = 0 THEN f ELSE n * 25 - l + 1 END AS INTEGER) AS cds_start,
  CAST(CASE WHEN doc_id % 2 = 0 THEN l ELSE n * 25 - f + 1 END AS INTEGER) AS cds_end
FROM stranded""")
def splice_exons(spark, sf_dir):
    """Exons on both strands, some given twice in part, spliced from a genome in pieces."""
    documents = table(spark, sf_dir, "documents")
    name = F.col("doc_id").cast("string")
    exons = (documents.filter(F.col("n_chars") >= 40)
             .select("doc_id", "n_chars", F.explode(F.sequence(
                 F.lit(0).cast("bigint"), F.floor(F.col("n_chars") / 40) - 1)).alias("i"))
             .withColumn("start", F.col("i") * 40 + 1 + F.col("doc_id") % 7)
             .withColumn("end", F.col("start") + 24)
             .filter(F.col("end") <= F.col("n_chars"))
             # An overlapping part of each exon, which adds nothing to the transcript.
             .withColumn("start", F.explode(F.array(F.col("start"), F.col("start") + 10))))
    kinds = F.when((F.col("i") >= 1) & (F.col("i") <= 4), F.array(F.lit("exon"), F.lit("CDS"))
                   ).otherwise(F.array(F.lit("exon")))
    features = exons.select(
        F.concat(F.lit("T"), name).alias("tx_id"), F.explode(kinds).alias("type"),
        F.concat(F.lit("D"), name).alias("seqid"), "start", "end",
        F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-").alias("strand"))
    genome = documents.select(F.concat(F.lit("D"), name).alias("seqid"),
                              F.lit(1).cast("bigint").alias("seq_start"), F.col("text").alias("seq"))
    bin_size = 512
    spliced = splice.splice(splice.transcript_models(features),
                            splice.cut_into_bins(genome, bin_size), bin_size)
    return spliced.select("tx_id", F.md5("seq").alias("bases"), "cds_start", "cds_end")


# Coding lines of those exons with phases, whose ends are moved into the exon or out of it.
_CODING = f"""{_EXONS},
ends AS (
  SELECT *, n * 25 AS size, least(n - 1, 4) AS m,
    26 + CASE WHEN doc_id % 5 = 0 THEN 0 ELSE doc_id % 11 END AS low,
    (least(n - 1, 4) + 1) * 25 - CASE WHEN doc_id % 4 = 0 THEN 0 ELSE doc_id % 9 END AS high
  FROM stranded),
coding AS (
  SELECT doc_id, seq, size,
    CASE WHEN n > 1 THEN CASE WHEN doc_id % 2 = 0 THEN low + ((doc_id + 1) % 4) % 3
      ELSE size - high + 1 + ((doc_id + m) % 4) % 3 END END AS a,
    CASE WHEN n > 1 THEN CASE WHEN doc_id % 2 = 0 THEN high ELSE size - low + 1 END END AS b
  FROM ends)"""


def _coding_models(spark, sf_dir) -> DataFrame:
    """Models from annotation lines, which are written as text and parsed again."""
    def line(kind: str, start: Column, end: Column, phase: Column) -> Column:
        return F.concat_ws("\t", F.concat(F.lit("D"), F.col("doc_id")), F.lit("src"), F.lit(kind), start, end,
                           F.lit("."), F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-"), phase,
                           F.concat(F.lit("Parent=T"), F.col("doc_id")))

    start = F.col("i") * 40 + 1 + F.col("doc_id") % 7
    end = start + 24
    phase = (F.col("doc_id") + F.col("i")) % 4
    exon = line("exon", start, end, F.lit("."))
    coding = line(
        "CDS", start + F.when(F.col("doc_id") % 5 == 0, -8).otherwise(F.col("doc_id") % 11),
        end - F.when(F.col("doc_id") % 4 == 0, -7).otherwise(F.col("doc_id") % 9),
        F.when(phase == 3, ".").otherwise(phase.cast("string")))
    sizes = table(spark, sf_dir, "documents").select("doc_id", "n_chars").filter(F.col("n_chars") >= 40)
    # The lines outgrow what is read for them, and a file may be read by one task.
    tasks = 3 * max(sizes.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)
    lines = (sizes.repartition(tasks, "doc_id")
             .select("doc_id", "n_chars", F.explode(F.sequence(
                 F.lit(0).cast("bigint"), F.floor(F.col("n_chars") / 40) - 1)).alias("i"))
             .filter(end <= F.col("n_chars"))
             .select(F.explode(F.when(F.col("i").between(1, 4), F.array(exon, coding))
                               .otherwise(F.array(exon))).alias("raw")))
    return splice.transcript_models(splice.features(lines))


@query(f"""WITH {_CODING}
SELECT 'T' || doc_id AS tx_id, CAST(a AS INTEGER) AS cds_start, CAST(b AS INTEGER) AS cds_end,
  md5(substring(seq, CAST(a AS BIGINT), CAST(b - a + 1 AS BIGINT))) AS coding_bases FROM coding""")
def coding_phase(spark, sf_dir):
    """Coding bases from the first whole codon on, of lines whose ends may miss the exons."""
    genome = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D"), F.col("doc_id")).alias("seqid"),
        F.lit(1).cast("bigint").alias("seq_start"), F.col("text").alias("seq"))
    bin_size = 512
    spliced = splice.splice(_coding_models(spark, sf_dir), splice.cut_into_bins(genome, bin_size), bin_size)
    return spliced.select("tx_id", "cds_start", "cds_end", F.md5(F.expr(
        "substring(seq, cds_start, cds_end - cds_start + 1)")).alias("coding_bases"))


@query(f"""WITH {_CODING}, forward AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN a ELSE size - a + 1 END - 1 AS f,
    CASE WHEN doc_id % 2 = 0 THEN b ELSE size - b + 1 END - 1 AS l FROM coding)
SELECT 'T' || doc_id AS tx_id, CAST(f // 25 * 40 + f % 25 + 1 + doc_id % 7 AS BIGINT) AS first_at,
  CAST(l // 25 * 40 + l % 25 + 1 + doc_id % 7 AS BIGINT) AS last_at FROM forward""")
def coding_positions(spark, sf_dir):
    """Genome positions of the first and last coding base in reading direction."""
    reverse = F.col("strand") == "-"
    return _coding_models(spark, sf_dir).select(
        "tx_id", splice.on_genome(F.col("exons"), reverse, F.col("cds_start")).alias("first_at"),
        splice.on_genome(F.col("exons"), reverse, F.col("cds_end")).alias("last_at"))
