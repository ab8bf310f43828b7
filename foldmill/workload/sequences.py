"""Sequence text: FASTA parsing, complement, energies, shuffles and folds."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from foldmill.functions.energies import energy_text, fixed4, fixed4_or_na, valid_energy
from foldmill.functions.sequences import reverse_complement
from foldmill.operators import scoring
from foldmill.operators.scorers import NeighbourScorer
from foldmill.sources.fasta import genome_pieces, parse_records
from foldmill.workload.registry import query, table


def named_documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("seqname"),
        F.col("text").alias("seq"), "n_chars", "lang")


@query("""
SELECT doc_id, md5(reverse(translate(text, 'ACGTURYKMBVDHacgturykmbvdh',
                                     'TGCAAYRMKVBHDtgcaayrmkvbhd'))) AS bases FROM documents""")
def revcomp(spark, sf_dir):
    """Reverse complement of every sequence, letter case kept."""
    return named_documents(spark, sf_dir).select(
        "doc_id", F.md5(reverse_complement(F.col("seq"))).alias("bases"))


_CLEAN = "translate(text, ' ' || chr(9) || chr(10) || chr(13), '')"


@query(f"""
SELECT 'D' || doc_id AS name, 'D' || doc_id || ' lang=' || lang AS header,
  CAST(length({_CLEAN}) AS INTEGER) AS length, md5({_CLEAN}) AS bases
FROM documents WHERE doc_id % 9 <> 4""")
def fasta_parse(spark, sf_dir):
    """Names, headers and sequences of FASTA records; nameless ones drop out."""
    name = F.when(F.col("doc_id") % 9 == 4, "").otherwise(F.col("seqname"))
    record = F.concat(F.lit(">"), name, F.lit(" lang="), F.col("lang"), F.lit("\r\n"), F.col("seq"))
    parsed = parse_records(named_documents(spark, sf_dir).select(record.alias("value")))
    return parsed.select("name", "header", F.length("seq").alias("length"), F.md5("seq").alias("bases"))


@query("""
WITH clean AS (
  SELECT 'D' || doc_id AS seqid, translate(text, ' ' || chr(13) || chr(10), '') AS seq FROM documents)
SELECT seqid, bin, md5(substring(seq, bin * 700 + 1, 700)) AS bases
FROM clean, unnest(generate_series(CAST(0 AS BIGINT), (length(seq) - 1) // 700)) AS g(bin)
WHERE length(seq) > 0""")
def genome_chunks(spark, sf_dir):
    """A line-wise FASTA file cut into bins, records running over input splits."""
    lines = (named_documents(spark, sf_dir)
             .select("doc_id", F.posexplode(F.concat(
                 F.array(F.concat(F.lit(">"), F.col("seqname"), F.lit(" text"))),
                 F.split("seq", "\n"))).alias("i", "raw"))
             .withColumn("line", F.col("doc_id") * 1_000_000 + F.col("i"))
             .select("raw", F.struct(F.lit("text").alias("file"),
                                     F.floor(F.col("line") / 37).alias("block"),
                                     F.col("line")).alias("pos")))
    pieces = genome_pieces(lines, bin_size=700)
    whole = pieces.groupBy("seqid", "bin").agg(F.array_join(F.transform(F.array_sort(
        F.collect_list(F.struct("piece_start", "seq"))), lambda p: p["seq"]), "").alias("seq"))
    return whole.select("seqid", "bin", F.md5("seq").alias("bases"))


# The same text for both engines.
_FOLDING_LINE = """
CASE o_orderkey % 6
  WHEN 0 THEN '....((..)) (' || (-o_totalprice / 100) || ')'
  WHEN 1 THEN '..((...)). ( -' || (o_orderkey % 90) || '.20)'
  WHEN 2 THEN '((.)) (  0.00) '
  WHEN 3 THEN '.... (' || (o_orderkey % 7) || '.)'
  WHEN 4 THEN '>s (' || (o_orderkey % 5) || ')'
  ELSE '..... (.' || (o_orderkey % 9) || ')' END"""


@query(f"""
WITH lines AS (SELECT o_orderkey, {_FOLDING_LINE} AS line FROM orders),
found AS (SELECT o_orderkey,
            nullif(regexp_extract(line, '\\(\\s*([-+]?[0-9]*\\.?[0-9]+)\\s*\\)$', 1), '') AS energy
          FROM lines)
SELECT o_orderkey, energy, CAST(energy AS DOUBLE) AS mfe FROM found""")
def mfe_line_parse(spark, sf_dir):
    """Energies read from folding-output lines."""
    lines = spark.sql(f"SELECT o_orderkey, {_FOLDING_LINE} AS line FROM {{orders}}",
                      orders=table(spark, sf_dir, "orders"))
    energy = energy_text(F.col("line"))
    return lines.select("o_orderkey", energy.alias("energy"), valid_energy(energy).alias("mfe"))


@query("""
SELECT o_orderkey, printf('%.4f', o_totalprice / 7) AS shown,
  CASE WHEN o_orderstatus = 'F' THEN 'NA' ELSE printf('%.4f', -o_totalprice / 13) END AS shown_or_na
FROM orders""")
def fixed_format(spark, sf_dir):
    """Four printed decimals, NA for null."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", fixed4(price / 7).alias("shown"),
        fixed4_or_na(F.when(F.col("o_orderstatus") != "F", -price / 13)).alias("shown_or_na"))


SHUFFLES = 5

_PAIRS_SQL = """
letters AS (SELECT doc_id, string_split(text, '') AS c FROM documents WHERE length(text) > 1),
pairs AS (SELECT doc_id, unnest(list_zip(c[1:-2], c[2:])) AS p FROM letters)"""


@query(f"""
WITH {_PAIRS_SQL},
counts AS (SELECT doc_id, p[1] || p[2] AS pair, count(*) AS n FROM pairs GROUP BY ALL),
lists AS (SELECT doc_id, count(*) AS n_pairs, md5(string_agg(pair || n, ',' ORDER BY pair)) AS digest
          FROM counts GROUP BY doc_id)
SELECT doc_id, iteration, n_pairs, digest
FROM lists, (SELECT unnest(generate_series(1, {SHUFFLES}))) AS v(iteration)""")
def dinuc_shuffle_invariants(spark, sf_dir):
    """Letter pairs of every shuffle of every text; the SQL has those of the texts."""
    documents = named_documents(spark, sf_dir).withColumn("n_shuffles", F.lit(SHUFFLES))
    return scoring.shuffled(documents, seed=1, reduce_to=_pair_digests,
                            schema="doc_id bigint, iteration bigint, n_pairs bigint, digest string")


# Letters whose pairs are counted together.
PAIR_LETTERS = 1 << 20


def _pair_digests(frame: pd.DataFrame) -> pd.DataFrame:
    """Number and digest of the counted letter pairs of every text of two letters or more."""
    frame = frame[frame["seq"].str.len() > 1]
    sizes = frame["seq"].str.len().to_numpy(np.int64)
    lots = (np.cumsum(sizes) - sizes) // PAIR_LETTERS
    found = [row for _, seqs in frame["seq"].groupby(lots, sort=True) for row in _counted_pairs(seqs.tolist())]
    return pd.DataFrame({"doc_id": frame["seqname"].str[1:].astype("int64"), "iteration": frame["iteration"],
                         "n_pairs": [n for n, _ in found], "digest": [digest for _, digest in found]})


def _counted_pairs(seqs: list[str]) -> Iterator[tuple[int, str]]:
    """Of all texts side by side: their pairs as numbers, sorted text by text and counted."""
    points = np.frombuffer("".join(seqs).encode("utf-32-le", "surrogatepass"), np.uint32)
    alphabet = np.zeros(int(points.max()) + 1, bool)
    alphabet[points] = True
    letters, codes = np.flatnonzero(alphabet), (np.cumsum(alphabet) - 1)[points]
    width = len(letters)
    ends = np.cumsum([len(s) for s in seqs])
    row = np.repeat(np.arange(len(seqs)), np.diff(ends, prepend=0))
    inner = np.ones(len(points), bool)
    inner[ends - 1] = False
    inner = np.flatnonzero(inner)
    # Below 2**63: at most 2**20 texts, unless one is longer than that, and 2**21 letters.
    keys = np.sort((row[inner] * width + codes[inner]) * width + codes[inner + 1])
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(first, append=len(keys))
    keys = keys[first]
    bounds = np.searchsorted(keys, np.arange(len(seqs) + 1) * width * width)
    pairs = keys % (width * width)
    known: dict[bytes, str] = {}    # of the shuffles of one text
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own, often = pairs[start:stop], counts[start:stop]
        name = own.tobytes() + often.tobytes()
        if name not in known:
            listed = ",".join(f"{chr(x)}{chr(y)}{n}" for x, y, n in zip(
                letters[own // width].tolist(), letters[own % width].tolist(), often.tolist()))
            known[name] = hashlib.md5(listed.encode()).hexdigest()
        yield stop - start, known[name]


@query("""
SELECT doc_id, iteration, n_chars, left(text, 1) AS first_letter, right(text, 1) AS last_letter
FROM documents, (VALUES (1), (2)) AS v(iteration)""")
def shuffle_shape(spark, sf_dir):
    """Shuffles keep the length and both ends."""
    documents = named_documents(spark, sf_dir).withColumn("n_shuffles", F.lit(2))
    seq = F.col("seq")
    return scoring.shuffled(documents, seed=2).select(
        F.substring("seqname", 2, 20).cast("bigint").alias("doc_id"), "iteration",
        F.length(seq).cast("bigint").alias("n_chars"), F.left(seq, F.lit(1)).alias("first_letter"),
        F.right(seq, F.lit(1)).alias("last_letter"))


@query(f"""
WITH {_PAIRS_SQL},
energies AS (SELECT doc_id, -CAST(sum((31 * unicode(p[1]) + 17 * unicode(p[2])) % 7) AS DOUBLE) AS e
             FROM pairs GROUP BY doc_id)
SELECT 'D' || documents.doc_id AS seq_name, coalesce(e, 0.0) + 0.0 AS orig_mfe,
  coalesce(e, 0.0) + 0.0 AS median_mfe, CAST(1.0 AS DOUBLE) AS pvalue, CAST(NULL AS DOUBLE) AS zscore,
  CAST({SHUFFLES} AS INTEGER) AS n_valid, CAST(0 AS INTEGER) AS n_missing,
  CAST({SHUFFLES} AS INTEGER) AS n_shuffles_requested, CAST(NULL AS VARCHAR) AS error
FROM documents LEFT JOIN energies ON documents.doc_id = energies.doc_id""")
def fold_score(spark, sf_dir):
    """Every whole text and its shuffles, folded and reduced.

    Each text has the same number of shuffles. The scorer is a sum over neighbouring letters, which
    a letter-pair shuffle keeps, so every score is known: the median is the own energy, the
    spread is 0, and no shuffle is lost.
    """
    documents = named_documents(spark, sf_dir).withColumn("n_shuffles", F.lit(SHUFFLES))
    scores = scoring.score_folds(scoring.fold_all(documents, NeighbourScorer(), seed=3))
    # -0.0 and 0.0 are one energy.
    return scores.withColumns({c: F.col(c) + F.lit(0.0) for c in ("orig_mfe", "median_mfe")})
