"""Transcript selection. Annotation lines are built from orders and line items.

An order is a transcript of its customer's gene, a line item one of its coding
or exon lines. The lines are text as in an annotation file and are parsed again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldmill.functions import attributes as attrs
from foldmill.functions.ids import normalise_id, original_id
from foldmill.operators import transcripts
from foldmill.operators.keys import having_key, keep_last
from foldmill.session import settle
from foldmill.sources.gff import parse_columns
from foldmill.workload.registry import query, table

TAGS = ("appris_principal_1", "appris_principal_2", "appris_principal_3",
        "Ensembl_canonical", "MANE_Select")

# Both engines evaluate this text, so the lines are equal.
_TRANSCRIPT_ATTRS = """
CASE o_orderkey % 3
  WHEN 0 THEN 'ID=t' || o_orderkey || ';transcript_id=T' || o_orderkey || '.1;gene_id=gene:G'
    || o_custkey || '.2;tag=basic,' || tag
  WHEN 1 THEN 'ID=transcript:T' || o_orderkey || ';Parent=gene:G' || o_custkey
    || ';transcript_id=transcript:T' || o_orderkey || '.3;tag=' || tag
  ELSE 'transcript_id=T' || o_orderkey
    || CASE WHEN o_orderkey % 50 = 2 THEN ';note=none' ELSE ';gene_id=G' || o_custkey END
    || ';tag=' || tag END"""

_TAGGED = """
SELECT o_orderkey, o_custkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN 'appris_principal_1' WHEN '2-HIGH' THEN 'appris_principal_10'
  WHEN '3-MEDIUM' THEN 'Ensembl_canonical'
  WHEN '4-NOT SPECIFIED' THEN 'MANE_Select,appris_principal_3' ELSE 'none' END AS tag
FROM orders"""

_LINES = f"""
SELECT o_orderkey AS pos, 'chr' || (o_custkey % 7) || chr(9) || 'src' || chr(9)
  || CASE WHEN o_orderkey % 2 = 0 THEN 'mRNA' ELSE 'transcript' END || chr(9) || '1' || chr(9)
  || '900' || chr(9) || '.' || chr(9) || '+' || chr(9) || '.' || chr(9) || {_TRANSCRIPT_ATTRS} AS raw
FROM ({_TAGGED}) AS tagged
UNION ALL
SELECT 10000000000 + o_orderkey, 'chr1' || chr(9) || 'src' || chr(9) || 'mRNA' || chr(9) || '1'
  || chr(9) || '900' || chr(9) || '.' || chr(9) || '+' || chr(9) || '.' || chr(9)
  || 'transcript_id=T' || o_orderkey || '.7;gene_id=G' || o_custkey || ';tag=MANE_Select'
FROM orders WHERE o_orderkey % 40 = 0
UNION ALL
SELECT 20000000000 + l_orderkey, 'chr1' || chr(9) || 'src' || chr(9)
  || CASE WHEN l_linenumber % 4 = 0 THEN 'exon' ELSE 'CDS' END || chr(9)
  || (l_partkey * 10 + 1) || chr(9)
  || (l_partkey * 10 + CAST(l_quantity AS INTEGER) * 3) || chr(9) || '.' || chr(9) || '+' || chr(9)
  || '0' || chr(9) || 'ID=c' || l_linenumber || ';Parent=transcript:T' || l_orderkey || '.9'
FROM lineitem
UNION ALL
SELECT -1 - r_regionkey, '#' || r_name || chr(9) || 'transcript' || chr(9) || 'transcript_id=T1'
FROM region"""

_GENE_LINES = """
SELECT '  gene:G' || c_custkey || '.5 ' AS value FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT 'G' || c_custkey FROM customer WHERE c_custkey % 10 = 1
UNION ALL SELECT '   ' FROM customer WHERE c_custkey % 100 = 0"""


def _norm(text: str) -> str:
    return f"split_part(split_part({text}, ':', -1), '.', 1)"


def _attr(key: str) -> str:
    return f"nullif(regexp_extract(raw, '{key}=([^; \\n]+)', 1), '')"


_CTES = f"""
ann AS ({_LINES}),
genes AS (SELECT DISTINCT {_norm('trim(value)')} AS gene_id FROM ({_GENE_LINES}) AS g
          WHERE trim(value) <> ''),
tx AS (
  SELECT pos, raw, {_norm(_attr('transcript_id'))} AS tx_id,
    split_part({_attr('transcript_id')}, ':', -1) AS orig_tx_id,
    {_norm(f"coalesce({_attr('gene_id')}, {_attr('Parent')})")} AS gene_id,
    CASE {' '.join(f"WHEN regexp_matches(raw, '\\b{t}\\b') THEN {i}" for i, t in enumerate(TAGS))}
      ELSE {len(TAGS)} END AS tag_rank
  FROM ann WHERE raw NOT LIKE '#%'
    AND (contains(raw, chr(9) || 'transcript' || chr(9)) OR contains(raw, chr(9) || 'mRNA' || chr(9)))
    AND {_attr('transcript_id')} IS NOT NULL
    AND coalesce({_attr('gene_id')}, {_attr('Parent')}) IS NOT NULL),
listed AS (SELECT tx.* FROM tx JOIN genes ON tx.gene_id = genes.gene_id),
cds AS (
  SELECT {_norm(_attr('Parent'))} AS tx_id,
    CAST(sum(CAST(split_part(raw, chr(9), 5) AS BIGINT)
             - CAST(split_part(raw, chr(9), 4) AS BIGINT) + 1) AS BIGINT) AS cds_len
  FROM ann WHERE raw NOT LIKE '#%' AND contains(raw, chr(9) || 'CDS' || chr(9)) GROUP BY 1),
latest AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY pos DESC) AS r FROM listed) AS l
  WHERE r = 1),
places AS (SELECT gene_id, tx_id, min(pos) AS pos FROM listed GROUP BY gene_id, tx_id),
cand AS (
  SELECT p.gene_id, p.tx_id, p.pos, l.orig_tx_id, l.tag_rank, coalesce(c.cds_len, 0) AS cds_len
  FROM places p JOIN latest l ON p.tx_id = l.tx_id LEFT JOIN cds c ON p.tx_id = c.tx_id),
best AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY gene_id ORDER BY tag_rank, cds_len DESC, pos) AS r
  FROM cand) AS b WHERE r = 1),
selected AS (
  SELECT gene_id, tx_id AS stripped_id, orig_tx_id AS orig_id,
    CASE tag_rank {' '.join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(TAGS))}
      ELSE 'longest_cds' END AS reason
  FROM best)"""


def annotation_lines(spark, sf_dir) -> DataFrame:
    text = _LINES
    for name in ("orders", "lineitem", "region"):
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}")
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "region")})


def ingested_lines(spark, sf_dir) -> DataFrame:
    """The lines as a stored table, for queries that read them more than once.

    They are dealt out evenly first: parsing is the costly part of what follows, and
    a small input file would leave all of it to one task. How many parts is left to Spark.
    """
    return settle(annotation_lines(spark, sf_dir).repartition("pos"))


def gene_list(spark, sf_dir) -> DataFrame:
    lines = spark.sql(_GENE_LINES.replace("FROM customer", "FROM {customer}"),
                      customer=table(spark, sf_dir, "customer"))
    return transcripts.requested_genes(lines)


@query(f"WITH {_CTES} SELECT gene_id FROM genes")
def gene_list_ids(spark, sf_dir):
    """Clean distinct ids of a gene list."""
    return gene_list(spark, sf_dir)


@query(f"""
SELECT page_id, {_norm('url')} AS bare_id, split_part(url, ':', -1) AS original_id FROM pages""")
def normalise_ids(spark, sf_dir):
    """Identifiers without prefix and version."""
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", normalise_id(url).alias("bare_id"), original_id(url).alias("original_id"))


@query(f"""WITH {_CTES}
SELECT pos, {_attr('gene_id')} AS gene, {_attr('Parent')} AS parent,
  coalesce({_attr('gene_id')}, {_attr('Parent')}) AS gene_or_parent,
  nullif(regexp_extract(raw, '(?:transcript_id=|Parent=)([^; \\n]+)', 1), '') AS owner,
  {" || ".join(f"CASE WHEN regexp_matches(raw, '\\b{t}\\b') THEN '{t} ' ELSE '' END" for t in TAGS)}
    AS tags
FROM ann WHERE raw NOT LIKE '#%'""")
def attr_extract_coalesce(spark, sf_dir):
    """Attributes, fallbacks and whole-word tags of annotation lines."""
    raw = F.col("raw")
    return annotation_lines(spark, sf_dir).filter(~attrs.is_comment(raw)).select(
        "pos", attrs.attribute(raw, "gene_id").alias("gene"),
        attrs.attribute(raw, "Parent").alias("parent"),
        attrs.first_attribute(raw, ["gene_id", "Parent"]).alias("gene_or_parent"),
        attrs.leftmost_attribute(raw, ["transcript_id", "Parent"]).alias("owner"),
        F.array_join(F.transform(attrs.tags_held(raw, TAGS), lambda t: F.concat(t, F.lit(" "))), "")
         .alias("tags"))


@query(f"""WITH {_CTES}
SELECT split_part(raw, chr(9), 1) AS seqid, split_part(raw, chr(9), 3) AS type,
  count(*) AS n_lines, CAST(min(CAST(split_part(raw, chr(9), 4) AS BIGINT)) AS BIGINT) AS first_start,
  CAST(max(CAST(split_part(raw, chr(9), 5) AS BIGINT)) AS BIGINT) AS last_end
FROM ann WHERE raw NOT LIKE '#%' GROUP BY 1, 2""")
def annotation_scan(spark, sf_dir):
    """Parsed annotation columns, comments left out."""
    lines = annotation_lines(spark, sf_dir).filter(~attrs.is_comment(F.col("raw")))
    return parse_columns(lines).groupBy("seqid", "type").agg(
        F.count("*").alias("n_lines"), F.min("start").alias("first_start"),
        F.max("end").alias("last_end"))


@query(f"WITH {_CTES} SELECT tx_id, orig_tx_id, gene_id, CAST(tag_rank AS INTEGER) AS tag_rank, pos FROM tx")
def transcript_features(spark, sf_dir):
    """Transcript lines with their ids; lines lacking an id are dropped."""
    lines = annotation_lines(spark, sf_dir)
    return transcripts.transcript_lines(lines, TAGS).select(
        "tx_id", "orig_tx_id", "gene_id", "tag_rank", "pos")


@query(f"WITH {_CTES} SELECT gene_id, count(*) AS n_transcripts FROM listed GROUP BY gene_id")
def requested_semi(spark, sf_dir):
    """Transcripts of requested genes, counted per gene."""
    listed = having_key(transcripts.transcript_lines(annotation_lines(spark, sf_dir)),
                        gene_list(spark, sf_dir), ["gene_id"])
    return listed.groupBy("gene_id").agg(F.count("*").alias("n_transcripts"))


@query(f"WITH {_CTES} SELECT gene_id, tx_id, cds_len FROM cand")
def cds_length_sum(spark, sf_dir):
    """Coding length per candidate transcript, zero where it has none."""
    return transcripts.candidates(ingested_lines(spark, sf_dir), gene_list(spark, sf_dir), TAGS
                                  ).select("gene_id", "tx_id", "cds_len")


@query(f"WITH {_CTES} SELECT * FROM selected")
def best_by_priority(spark, sf_dir):
    """One transcript per gene by tag priority and coding length."""
    return transcripts.select_transcripts(ingested_lines(spark, sf_dir),
                                          gene_list(spark, sf_dir), TAGS)


@query(f"""WITH {_CTES}, owned AS (
  SELECT {_norm("regexp_extract(raw, '(?:transcript_id=|Parent=)([^; \\n]+)', 1)")} AS stripped_id
  FROM ann WHERE raw NOT LIKE '#%')
SELECT stripped_id, count(*) AS n_lines FROM owned
WHERE stripped_id IN (SELECT stripped_id FROM selected) GROUP BY stripped_id""")
def filtered_annotation(spark, sf_dir):
    """Annotation lines of the chosen transcripts, counted per transcript."""
    lines = ingested_lines(spark, sf_dir)
    chosen = transcripts.select_transcripts(lines, gene_list(spark, sf_dir), TAGS)
    return transcripts.selected_lines(lines, chosen).groupBy("stripped_id").agg(
        F.count("*").alias("n_lines"))


@query("""
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
  FROM events) AS e WHERE r = 1""")
def keep_last_dedupe(spark, sf_dir):
    """Last row per key."""
    return keep_last(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value")
