"""Robust scores. Prices stand for energies and keys for sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldmill.operators import robust, scoring, selection
from foldmill.operators.ranking import with_index
from foldmill.workload.registry import query, table

# SQL of a score, given CTEs obs(k, orig, e) and bg(k, v).
_SCORE_CTES = """
med AS (SELECT k, median(v) AS m FROM bg WHERE v IS NOT NULL GROUP BY k),
mad AS (SELECT bg.k, median(abs(v - m)) AS d FROM bg JOIN med ON bg.k = med.k
        WHERE v IS NOT NULL GROUP BY bg.k),
cnt AS (SELECT bg.k, count(v) AS n, count(CASE WHEN v <= orig THEN 1 END) AS c
        FROM bg JOIN obs ON bg.k = obs.k GROUP BY bg.k),
summary AS (
  SELECT obs.k, obs.orig, obs.e, med.m, mad.d, coalesce(cnt.n, 0) AS n, coalesce(cnt.c, 0) AS c
  FROM obs LEFT JOIN med ON obs.k = med.k LEFT JOIN mad ON obs.k = mad.k
  LEFT JOIN cnt ON obs.k = cnt.k),
scored AS (
  SELECT k, orig AS orig_mfe,
    CASE WHEN e > 0 THEN round(m, 4) END AS median_mfe,
    CASE WHEN e > 0 AND m IS NOT NULL THEN
      round((c + CASE WHEN orig <= m THEN e - n ELSE 0 END + 1) / CAST(e + 1 AS DOUBLE), 6)
    END AS pvalue,
    CASE WHEN e > 0 AND d <> 0 THEN round((orig - m) / (d * 1.4826), 6) END AS zscore,
    CAST(CASE WHEN e > 0 THEN n ELSE 0 END AS INTEGER) AS n_valid,
    CAST(CASE WHEN e > 0 THEN e - n ELSE 0 END AS INTEGER) AS n_missing,
    CAST(e AS INTEGER) AS n_shuffles_requested
  FROM summary)
"""

_COLUMNS = ("orig_mfe, median_mfe, pvalue, zscore, n_valid, n_missing, n_shuffles_requested")


def _shown(scored: DataFrame, *key: str) -> DataFrame:
    return scored.select(
        *key, "orig_mfe", F.round("median_mfe", 4).alias("median_mfe"),
        F.round("pvalue", 6).alias("pvalue"), F.round("zscore", 6).alias("zscore"),
        "n_valid", "n_missing", "n_shuffles_requested")


@query(f"""
WITH obs AS (SELECT s_suppkey AS k, s_acctbal * 8 AS orig, 1000 AS e FROM supplier),
bg AS (SELECT l_suppkey AS k, l_extendedprice AS v FROM lineitem), {_SCORE_CTES}
SELECT k AS s_suppkey, {_COLUMNS} FROM scored""")
def robust_zscore(spark, sf_dir):
    """Median, MAD, z-score and p-value per supplier."""
    observed = table(spark, sf_dir, "supplier").select(
        "s_suppkey", (F.col("s_acctbal") * 8).alias("orig_mfe"), F.lit(1000).alias("n_shuffles"))
    background = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("s_suppkey"), F.col("l_extendedprice").alias("mfe"))
    return _shown(robust.score(robust.summarise(observed, background, ["s_suppkey"])), "s_suppkey")


@query(f"""
WITH obs AS (SELECT l_returnflag AS k, max(l_extendedprice) / 4 AS orig,
                    CAST(count(*) + count(*) // 10 AS BIGINT) AS e
             FROM lineitem GROUP BY l_returnflag),
bg AS (SELECT l_returnflag AS k, l_extendedprice AS v FROM lineitem), {_SCORE_CTES}
SELECT k AS l_returnflag, {_COLUMNS} FROM scored""")
def robust_zscore_skewed(spark, sf_dir):
    """The same score for three groups that hold all rows, by counting."""
    lineitem = table(spark, sf_dir, "lineitem")
    observed = lineitem.groupBy("l_returnflag").agg(
        (F.max("l_extendedprice") / 4).alias("orig_mfe"),
        (F.count("*") + F.floor(F.count("*") / 10)).alias("n_shuffles"))
    background = lineitem.select("l_returnflag", F.col("l_extendedprice").alias("mfe"))
    summary = robust.summarise(observed, background, ["l_returnflag"])
    return _shown(robust.score(summary), "l_returnflag")


@query(f"""
WITH obs AS (SELECT c_custkey AS k, c_acctbal * 30 AS orig, 20 AS e FROM customer),
bg AS (SELECT o_custkey AS k, o_totalprice AS v FROM orders), {_SCORE_CTES}
SELECT k AS c_custkey, orig_mfe, pvalue, n_valid, n_missing FROM scored""")
def empirical_pvalue(spark, sf_dir):
    """Lower-tail p-value per customer, customers without orders included."""
    observed = table(spark, sf_dir, "customer").select(
        "c_custkey", (F.col("c_acctbal") * 30).alias("orig_mfe"), F.lit(20).alias("n_shuffles"))
    background = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("mfe"))
    scored = robust.score(robust.summarise(observed, background, ["c_custkey"]))
    return _shown(scored, "c_custkey").select("c_custkey", "orig_mfe", "pvalue", "n_valid", "n_missing")


_PART_CTES = f"""
WITH obs AS (SELECT p_partkey AS k, p_retailprice * 20 AS orig,
                    CASE WHEN p_size % 5 = 0 THEN 0 ELSE 34 END AS e FROM part),
bg AS (SELECT l_partkey AS k, l_extendedprice AS v FROM lineitem), {_SCORE_CTES}"""


def _part_scores(spark, sf_dir) -> DataFrame:
    observed = table(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_retailprice") * 20).alias("orig_mfe"),
        F.when(F.col("p_size") % 5 == 0, 0).otherwise(34).alias("n_shuffles"))
    background = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").alias("mfe"))
    return robust.score(robust.summarise(observed, background, ["p_partkey"]))


@query(f"{_PART_CTES} SELECT k AS p_partkey, {_COLUMNS} FROM scored")
def mfe_only_rows(spark, sf_dir):
    """Rows without requested shuffles keep their energy and get no score."""
    return _shown(_part_scores(spark, sf_dir), "p_partkey")


@query(f"""{_PART_CTES}
SELECT k AS p_partkey, n_valid, n_shuffles_requested,
  CASE WHEN n_shuffles_requested > 0 AND n_valid < (n_shuffles_requested * 90) // 100
       THEN 'insufficient shuffles (' || n_valid || '/' || n_shuffles_requested || ')' END AS error
FROM scored""")
def min_valid_split(spark, sf_dir):
    """Sequences with too few valid shuffles get an error."""
    return robust.with_error(_part_scores(spark, sf_dir)).select(
        "p_partkey", "n_valid", "n_shuffles_requested", "error")


@query("""
SELECT CAST(user_id AS VARCHAR) AS transcript_id,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INTEGER) AS iteration,
  -value AS shuffled_mfe
FROM events WHERE event_type <> 'error' AND value IS NOT NULL""")
def raw_shuffle_rows(spark, sf_dir):
    """Valid shuffle energies numbered without gaps, in groups of any size."""
    folds = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("seqname"),
        (F.col("event_id") + 1).alias("iteration"),
        F.when(F.col("event_type") != "error", -F.col("value")).alias("mfe"))
    return scoring.raw_shuffles(folds, bounded=False)


@query(f"""
WITH folds AS (
  SELECT user_id AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i,
    CASE WHEN event_type <> 'error' THEN -value END AS v FROM events),
obs AS (SELECT k, max(CASE WHEN i = 0 THEN v END) AS orig, max(i) AS e FROM folds GROUP BY k),
bg AS (SELECT k, v FROM folds WHERE i > 0), {_SCORE_CTES}
SELECT CAST(k AS VARCHAR) AS seq_name, {_COLUMNS},
  CASE WHEN orig_mfe IS NULL THEN 'invalid orig MFE'
       WHEN n_shuffles_requested > 0 AND n_valid < (n_shuffles_requested * 90) // 100
       THEN 'insufficient shuffles (' || n_valid || '/' || n_shuffles_requested || ')' END AS error
FROM scored""")
def score_from_folds(spark, sf_dir):
    """Folds reduced as the scoring step does: a user's events are a sequence and its shuffles."""
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("seqname"), "event_id", "event_type", "value")
    # A user may have any number of events, so they are numbered over ranges, not in one window.
    placed = with_index(events, ["seqname"], ["event_id"], "iteration")
    sizes = events.groupBy("seqname").agg((F.count("*") - 1).cast("int").alias("n_shuffles"))
    folds = placed.join(sizes, "seqname").select(
        "seqname", "iteration", F.when(F.col("event_type") != "error", -F.col("value")).alias("mfe"),
        "n_shuffles", F.lit(None).cast("string").alias("problem"))
    return _shown(scoring.score_folds(folds, bounded=False), "seq_name", "error")


@query("""
SELECT o_orderstatus, count(*) AS n, round(median(o_totalprice), 4) AS median
FROM orders GROUP BY o_orderstatus""")
def exact_group_median(spark, sf_dir):
    """Exact median of groups of any size (A2)."""
    medians = selection.grouped_median(table(spark, sf_dir, "orders"), ["o_orderstatus"], "o_totalprice")
    return medians.select("o_orderstatus", "n", F.round("median", 4).alias("median"))
