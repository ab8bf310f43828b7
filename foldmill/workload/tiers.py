"""Length tiers, calibration and task lists. Documents stand for sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from foldmill.fixed_values import TIER_BOUNDS
from foldmill.functions import durations, tiers
from foldmill.operators import calibrate, stratify, submit
from foldmill.operators.keys import having_key
from foldmill.workload.registry import query, table

# Bounds that leave the first and the last tier of any documents empty.
SPARSE_BOUNDS = (0, 150, 280, 500, 900, 1600, 2800, 5000, 2_000_000_000)


def tiered_sql(bounds=(80, 150, 280, 500, 900, 1600, 2800, 5000, 10000)) -> str:
    cases = " ".join(f"WHEN n_chars < {b} THEN {n}" for n, b in enumerate(bounds, 1))
    labels = [f"{a}-{b}" for a, b in zip((0, *bounds), bounds)] + [f">{bounds[-1]}"]
    shuffles = [1000] * 7 + [100, 10, 0]
    policy = ", ".join(f"({n}, {s}, '{label}')" for n, (s, label) in enumerate(zip(shuffles, labels), 1))
    return f"""
tiered AS (
  SELECT doc_id, 'D' || doc_id AS seqname, CAST(n_chars AS INTEGER) AS length,
    CASE {cases} ELSE 10 END AS tier FROM documents),
policy AS (
  SELECT CAST(tier AS INTEGER) AS tier, n_shuffles, label
  FROM (VALUES {policy}) AS p(tier, n_shuffles, label))
"""


TIERED_SQL = tiered_sql()


def samples_sql(tiered: str = TIERED_SQL) -> str:
    return f"""
WITH {tiered},
ranked AS (SELECT *, row_number() OVER (PARTITION BY tier ORDER BY length DESC, seqname DESC) AS r
           FROM tiered),
samples AS (
  SELECT ranked.tier, seqname, length, n_shuffles,
    CAST(floor(length * 0.0375 + 0.5) AS INTEGER) AS wall_s,
    CAST((40000 + length * 31) // 1024 AS INTEGER) AS rss_mb
  FROM ranked JOIN policy ON ranked.tier = policy.tier WHERE r <= 3)
"""


SAMPLES_SQL = samples_sql()


def tiered_documents(spark, sf_dir, bounds=TIER_BOUNDS) -> DataFrame:
    sequences = table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("seqname"),
        F.col("n_chars").cast("int").alias("length"))
    return stratify.assign_tiers(sequences, bounds=bounds)


def _samples(spark, sf_dir, bounds=TIER_BOUNDS) -> DataFrame:
    longest = stratify.longest_per_tier(tiered_documents(spark, sf_dir, bounds))
    return calibrate.per_sample(longest.select(
        "tier", "seqname", "length", "n_shuffles",
        (F.col("length") * 0.0375).alias("wall"),
        (F.lit(40000) + F.col("length") * 31).alias("rss_kb")))


@query(f"""WITH {TIERED_SQL}
SELECT doc_id, length, tiered.tier, n_shuffles, label AS range
FROM tiered JOIN policy ON tiered.tier = policy.tier""")
def tier_assign(spark, sf_dir):
    """Tier, range label and shuffle count of every sequence."""
    return tiered_documents(spark, sf_dir).select(
        "doc_id", "length", "tier", "n_shuffles", tiers.tier_range(F.col("tier")).alias("range"))


@query(f"""WITH {tiered_sql(SPARSE_BOUNDS)},
counts AS (SELECT policy.tier, label AS range, count(tiered.doc_id) AS count
           FROM policy LEFT JOIN tiered ON policy.tier = tiered.tier
           GROUP BY policy.tier, label)
SELECT tier, range, count FROM counts
UNION ALL SELECT NULL, 'total', CAST(sum(count) AS BIGINT) FROM counts""")
def tier_histogram(spark, sf_dir):
    """Sequences per tier with empty tiers and the total."""
    tiered = tiered_documents(spark, sf_dir, SPARSE_BOUNDS)
    return stratify.with_total(stratify.tier_counts(tiered, SPARSE_BOUNDS))


@query(f"{SAMPLES_SQL} SELECT tier, seqname, length, n_shuffles FROM samples")
def topk_longest_per_tier(spark, sf_dir):
    """Three longest sequences of each tier."""
    return stratify.longest_per_tier(tiered_documents(spark, sf_dir)).select(
        "tier", "seqname", "length", "n_shuffles")


@query(f"{SAMPLES_SQL} SELECT tier, seqname, length, n_shuffles, wall_s, rss_mb FROM samples")
def calibration_samples(spark, sf_dir):
    """Measured samples in whole seconds and megabytes."""
    return _samples(spark, sf_dir)


@query(f"""{SAMPLES_SQL}
SELECT doc_id, samples.tier, length(text) AS n_chars FROM samples
JOIN documents ON samples.seqname = 'D' || doc_id WHERE doc_id % 4 <> 1""")
def sample_sequences(spark, sf_dir):
    """Sequences of the longest of each tier; one that has no sequence is left out."""
    tiered = tiered_documents(spark, sf_dir)
    longest = stratify.longest_per_tier(tiered.select("tier", "seqname", "length"))
    texts = table(spark, sf_dir, "documents").filter("doc_id % 4 <> 1").select(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("seqname"), "text")
    return having_key(tiered.join(texts, "seqname"), longest, ["tier", "seqname"]).select(
        "doc_id", "tier", F.length("text").cast("bigint").alias("n_chars"))


def _recommended_sql(samples: str = SAMPLES_SQL) -> str:
    return f"""{samples},
recommended AS (
  SELECT tier, n_shuffles, CAST(count(*) AS INTEGER) AS n_samples, max(length) AS max_len,
    max(wall_s) AS max_wall_s, max(rss_mb) AS max_rss_mb,
    printf('%02d:%02d:00', ((max(wall_s) * 2 + 59) // 60) // 60,
           ((max(wall_s) * 2 + 59) // 60) % 60) AS rec_time,
    greatest(200, max(rss_mb) * 2) || 'MB' AS rec_mem
  FROM samples GROUP BY tier, n_shuffles)"""


_RECOMMENDED_SQL = _recommended_sql()


@query(f"{_recommended_sql(samples_sql(tiered_sql(SPARSE_BOUNDS)))} SELECT * FROM recommended")
def tier_recommendations(spark, sf_dir):
    """Time and memory to ask for, per tier that has samples."""
    return calibrate.recommend(_samples(spark, sf_dir, SPARSE_BOUNDS))


@query(f"""{_RECOMMENDED_SQL},
sizes AS (SELECT tier, count(*) AS n_tasks FROM tiered GROUP BY tier),
listed AS (SELECT count(*) AS n_tasks FROM tiered WHERE tier = 4 AND doc_id % 2 = 0)
SELECT 't' || r.tier AS tag, r.tier, n_tasks, n_shuffles, rec_time, rec_mem,
  '0-' || (n_tasks - 1) || '%10' AS array_range
FROM recommended r JOIN sizes ON r.tier = sizes.tier
UNION ALL
SELECT 'custom', NULL, n_tasks, 1000, '00:05:00', '300MB', '0-' || (n_tasks - 1) || '%10'
FROM listed WHERE n_tasks > 0""")
def submission_plan(spark, sf_dir):
    """Array jobs of all tiers and of an explicit list."""
    tiered = tiered_documents(spark, sf_dir)
    explicit = tiered.filter((F.col("tier") == 4) & (F.col("doc_id") % 2 == 0))
    return submit.tier_plan(tiered, calibrate.recommend(_samples(spark, sf_dir))).unionByName(
        submit.list_plan(explicit, 1000, "00:05:00", "300MB"))


_INDEXED_SQL = f"""WITH {TIERED_SQL},
indexed AS (SELECT doc_id, tier,
              row_number() OVER (PARTITION BY tier ORDER BY length DESC, doc_id) - 1 AS idx
            FROM tiered)"""


def _indexed(spark, sf_dir) -> DataFrame:
    narrow = tiered_documents(spark, sf_dir).select("doc_id", "tier", "length")
    return submit.index_tasks(narrow, ["tier"], [F.col("length").desc(), F.col("doc_id")])


@query(f"{_INDEXED_SQL} SELECT doc_id, tier, idx FROM indexed")
def array_index(spark, sf_dir):
    """Place of each task in its tier's list."""
    return _indexed(spark, sf_dir).select("doc_id", "tier", "idx")


@query(f"{_INDEXED_SQL} SELECT tier, doc_id FROM indexed WHERE idx = 5")
def positional_fetch(spark, sf_dir):
    """The task at one place of each tier's list."""
    return submit.task_at(_indexed(spark, sf_dir), 5).select("tier", "doc_id")


_ELAPSED_SQL = """
CASE event_id % 4
  WHEN 0 THEN (event_id % 30) || ':' || (event_id % 60) || ':' || value
  WHEN 1 THEN (event_id % 60) || ':' || value
  WHEN 2 THEN CAST(value AS VARCHAR)
  ELSE '1:2:3:' || value END"""


@query(f"""
WITH lines AS (SELECT event_id, value, {_ELAPSED_SQL} AS elapsed FROM events),
timed AS (
  SELECT event_id, elapsed, value, CASE event_id % 4
    WHEN 0 THEN (event_id % 30) * 3600.0 + (event_id % 60) * 60.0 + value
    WHEN 1 THEN (event_id % 60) * 60.0 + value
    WHEN 2 THEN value END AS seconds FROM lines),
whole AS (SELECT event_id, elapsed, round(CAST(seconds AS DOUBLE), 6) AS seconds,
            CAST(floor(seconds + 0.5) AS INTEGER) AS wall_s FROM timed)
SELECT event_id, elapsed, seconds, wall_s,
  CASE WHEN wall_s IS NOT NULL THEN
    printf('%02d:%02d:00', ((wall_s + 59) // 60) // 60, ((wall_s + 59) // 60) % 60) END AS rec_time
FROM whole""")
def duration_parse_format(spark, sf_dir):
    """Elapsed times to seconds, and seconds to clock time in whole minutes."""
    number, value = F.col("event_id"), F.col("value").cast("string")

    def part(modulus: int):
        return (number % modulus).cast("string")

    elapsed = (F.when(number % 4 == 0, F.concat_ws(":", part(30), part(60), value))
               .when(number % 4 == 1, F.concat_ws(":", part(60), value))
               .when(number % 4 == 2, value)
               .otherwise(F.concat(F.lit("1:2:3:"), value)))
    return (table(spark, sf_dir, "events").select("event_id", elapsed.alias("elapsed"))
            .withColumn("seconds", F.round(durations.elapsed_seconds(F.col("elapsed")), 6))
            .withColumn("wall_s", durations.whole_seconds(F.col("seconds")))
            .withColumn("rec_time", durations.clock_minutes(F.col("wall_s"))))
