"""Combining results with metadata, and finding unfinished work."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldmill.operators import collate, resume, stratify
from foldmill.sources.headed import by_header
from foldmill.workload.registry import query, table
from foldmill.workload.tiers import TIERED_SQL, tiered_documents

# Manifest of documents with repeats: a second listing for every tenth document.
_MANIFEST_SQL = """
listing AS (
  SELECT doc_id AS place, 'D' || doc_id AS seqname, 'G' || doc_id AS gene_id,
    'T' || doc_id || '.1' AS transcript_id, lang AS region, CAST(n_chars AS INTEGER) AS length,
    'MANE_Select' AS selection_reason, n_chars < 300 AS short_utrs
  FROM documents WHERE doc_id % 4 <> 1
  UNION ALL
  SELECT doc_id + 1000000000, 'D' || doc_id, 'G' || doc_id, 'T' || doc_id || '.2', lang,
    CAST(n_chars AS INTEGER), 'longest_cds', false
  FROM documents WHERE doc_id % 10 = 0),
manifest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY seqname ORDER BY place DESC) AS r FROM listing) AS l
  WHERE r = 1)"""


def manifest(spark, sf_dir) -> DataFrame:
    number = F.col("doc_id").cast("string")
    documents = table(spark, sf_dir, "documents")

    def listed(rows: DataFrame, version: str, place, reason: str, short) -> DataFrame:
        return rows.select(
            place.alias("place"), F.concat(F.lit("D"), number).alias("seqname"),
            F.concat(F.lit("G"), number).alias("gene_id"),
            F.concat(F.lit("T"), number, F.lit(version)).alias("transcript_id"),
            F.col("lang").alias("region"), F.col("n_chars").cast("int").alias("length"),
            F.lit(reason).alias("selection_reason"), short.alias("short_utrs"))

    listing = listed(documents.filter(F.col("doc_id") % 4 != 1), ".1", F.col("doc_id"),
                     "MANE_Select", F.col("n_chars") < 300).unionByName(
        listed(documents.filter(F.col("doc_id") % 10 == 0), ".2", F.col("doc_id") + 1000000000,
               "longest_cds", F.lit(False)))
    return collate.latest_manifest(listing, ["place"]).drop("place")


@query(f"""WITH {_MANIFEST_SQL},
results AS (
  SELECT 'D' || doc_id AS seq_name, n_chars / -7.0 AS orig_mfe,
    CASE WHEN doc_id % 3 <> 0 THEN n_chars / -11.0 END AS median_mfe,
    CASE WHEN doc_id % 3 <> 0 THEN (doc_id % 97 + 1) / 1001.0 END AS pvalue,
    CASE WHEN doc_id % 5 <> 0 THEN n_chars / -1300.0 END AS zscore,
    doc_id % 97 AS n_valid, 1 AS n_missing, 1000 AS n_shuffles_requested
  FROM documents)
SELECT seq_name AS seqname, coalesce(gene_id, '') AS gene_id,
  coalesce(transcript_id, '') AS transcript_id, coalesce(region, '') AS region,
  coalesce(CAST(length AS VARCHAR), '') AS length, coalesce(selection_reason, '') AS selection_reason,
  coalesce(CAST(short_utrs AS VARCHAR), '') AS short_utrs,
  printf('%.4f', CAST(orig_mfe AS DOUBLE)) AS orig_mfe,
  coalesce(printf('%.4f', CAST(median_mfe AS DOUBLE)), 'NA') AS median_mfe,
  coalesce(printf('%.4f', CAST(pvalue AS DOUBLE)), 'NA') AS pvalue,
  coalesce(printf('%.4f', CAST(zscore AS DOUBLE)), 'NA') AS zscore,
  CAST(n_valid AS VARCHAR) AS n_valid, CAST(n_missing AS VARCHAR) AS n_missing,
  CAST(n_shuffles_requested AS VARCHAR) AS n_shuffles_requested
FROM results LEFT JOIN manifest ON seq_name = seqname""")
def collate_left(spark, sf_dir):
    """Every result with its metadata, as printed."""
    number, size = F.col("doc_id"), F.col("n_chars")
    results = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("D"), number.cast("string")).alias("seq_name"), (size / -7.0).alias("orig_mfe"),
        F.when(number % 3 != 0, size / -11.0).alias("median_mfe"),
        F.when(number % 3 != 0, (number % 97 + 1) / 1001.0).alias("pvalue"),
        F.when(number % 5 != 0, size / -1300.0).alias("zscore"),
        (number % 97).alias("n_valid"), F.lit(1).alias("n_missing"),
        F.lit(1000).alias("n_shuffles_requested"))
    return collate.printed(collate.collate_results(results, manifest(spark, sf_dir)))


@query("""
SELECT CAST(l_orderkey AS VARCHAR) AS seqname, 'G' || o_custkey AS gene_id,
  'T' || o_orderkey AS transcript_id, o_orderstatus AS region,
  l_linenumber AS iteration, -l_extendedprice AS shuffled_mfe
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderkey % 4 <> 0""")
def collate_long(spark, sf_dir):
    """Every shuffle row with three metadata columns."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("transcript_id"),
        F.col("l_linenumber").alias("iteration"), (-F.col("l_extendedprice")).alias("shuffled_mfe"))
    key = F.col("o_orderkey").cast("string")
    metadata = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 4 != 0).select(
        key.alias("seqname"), F.concat(F.lit("G"), F.col("o_custkey").cast("string")).alias("gene_id"),
        F.concat(F.lit("T"), key).alias("transcript_id"), F.col("o_orderstatus").alias("region"))
    return collate.collate_raw(raw, metadata)


@query("""
SELECT event_id, user_id, CASE WHEN event_id % 3 <> 2 THEN event_type END AS event_type, value,
  CASE WHEN event_id % 3 = 1 THEN props END AS props, CASE WHEN event_id % 3 = 2 THEN event_type END AS kind
FROM events""")
def mixed_headers(spark, sf_dir):
    """All events written as lines of three files whose headers differ, and read back."""
    events = table(spark, sf_dir, "events")
    quoted = F.concat(F.lit('"'), F.replace("props", F.lit('"'), F.lit('""')), F.lit('"'))
    text = {c: F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in ("event_id", "user_id", "event_type", "value")}
    # Reordered columns, further ones before and behind, and one that is missing.
    kinds = [("event_id,user_id,event_type,value", ["event_id", "user_id", "event_type", "value"]),
             ("props,value,event_type,user_id,event_id", ["props", "value", "event_type", "user_id", "event_id"]),
             ("user_id,kind,value,event_id", ["user_id", "event_type", "value", "event_id"])]
    text["props"] = F.coalesce(quoted, F.lit("NA"))
    number = (F.col("event_id") % 3).cast("int")
    line = F.when(number == 0, F.concat_ws(",", *(text[c] for c in kinds[0][1]))).when(
        number == 1, F.concat_ws(",", *(text[c] for c in kinds[1][1]))).otherwise(
        F.concat_ws(",", *(text[c] for c in kinds[2][1])))
    lines = events.select(line.alias("value"), F.struct(
        number.cast("string").alias("file"), F.col("event_id").alias("line")).alias("pos"))
    headers = spark.createDataFrame([(h, (str(n), -1)) for n, (h, _) in enumerate(kinds)],
                                    "value string, pos struct<file: string, line: bigint>")
    rows = by_header(lines.unionByName(headers), "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
                     extra=True, null="NA")
    return rows.select("event_id", "user_id", "event_type", "value", "props", "kind")


@query("""
WITH turns AS (SELECT conv_id, count(*) AS n_turns FROM conversations GROUP BY conv_id)
SELECT 'D' || d.doc_id AS seqname, lang AS region, n_chars AS length, quality, toxic, n_turns
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id LEFT JOIN turns t ON d.doc_id = t.conv_id""")
def metric_join_chain(spark, sf_dir):
    """Manifest joined with one metric table after another."""
    def named(rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumn("seqname", F.concat(F.lit("D"), F.col(key).cast("string"))).drop(key)

    metadata = named(table(spark, sf_dir, "documents").select(
        "doc_id", F.col("lang").alias("region"), F.col("n_chars").alias("length")), "doc_id")
    labels = named(table(spark, sf_dir, "labels"), "doc_id")
    turns = named(table(spark, sf_dir, "conversations").groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.lit("x").alias("region")), "conv_id")
    return collate.join_metrics(metadata.select("seqname", "region", "length"), [labels, turns])


def _scored_names(spark, sf_dir, quality: int) -> DataFrame:
    return table(spark, sf_dir, "labels").filter(F.col("quality") == quality).select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("seq_name"))


@query(f"""WITH {TIERED_SQL}
SELECT seqname, tier FROM tiered
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def resume_anti(spark, sf_dir):
    """Sequences of all tiers without a result."""
    done = resume.completed(_scored_names(spark, sf_dir, 1))
    return resume.unfinished(tiered_documents(spark, sf_dir), done).select("seqname", "tier")


@query(f"""WITH {TIERED_SQL}
SELECT seqname, tier FROM tiered
WHERE tier IN (5, 6, 7) AND doc_id NOT IN (SELECT doc_id FROM labels)""")
def resume_tiers(spark, sf_dir):
    """Unfinished sequences of some tiers, failed ones not repeated."""
    failed = _scored_names(spark, sf_dir, 0).withColumnRenamed("seq_name", "seqname")
    done = resume.completed(_scored_names(spark, sf_dir, 1), failed)
    return resume.unfinished(tiered_documents(spark, sf_dir), done, [5, 6, 7]).select("seqname", "tier")


@query("""
SELECT DISTINCT 'C' || conv_id || '_' || turn AS seqname FROM conversations
WHERE length(text) - length(replace(text, chr(10), '')) >= 2""")
def completed_files(spark, sf_dir):
    """Result files with a header and a row, by their line ends."""
    files = table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("out/results_C"), F.col("conv_id").cast("string"), F.lit("_"),
                 F.col("turn").cast("string"), F.lit(".csv")).alias("path"),
        F.col("text").alias("content"))
    return resume.completed_files(files)


@query("SELECT 'D' || doc_id AS seqname FROM documents WHERE doc_id % 4 = 1 AND doc_id % 10 <> 0")
def orphan_sequences(spark, sf_dir):
    """Sequences the manifest does not list."""
    return stratify.orphan_sequences(tiered_documents(spark, sf_dir), manifest(spark, sf_dir)
                                     ).select("seqname")
