"""Stratify, calibrate, submit, score and resume."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.config import RunConfig
from foldmill.functions.ids import file_key
from foldmill.operators import calibrate, resources, resume, scoring, stratify, submit
from foldmill.operators.keys import having_key, lacking_key, top_rows
from foldmill.plans.provenance import read_if_exists
from foldmill.session import folder_exists, remove_folder
from foldmill.sources import fasta, sinks, tables
from foldmill.sources.text import read_whole_files

log = logging.getLogger(__name__)

# Sequences that are folded, reduced and committed together.
BATCH_SEQUENCES = 1_000_000


def read_sequences(spark: SparkSession, run: RunConfig) -> DataFrame:
    """``seqname, seq, length`` of the regions the manifest names, one row per name.

    Of records of one name the last in the file stays; the Parquet table has no order, so there
    the one whose text sorts last does.
    """
    # A handful of region names, known before the sequences are read, so that other folders are not.
    listed = [row.region for row in
              tables.manifest_rows(spark, run.manifest_tsv).select("region").distinct().collect()]
    regions = read_if_exists(spark, f"{run.multifasta_dir}/regions")
    if regions is None:
        records = fasta.read_latest_records(spark, f"{run.multifasta_dir}/fasta")
        return (records.filter(F.col("region").isin(listed))
                .select(F.col("name").alias("seqname"), "seq", F.length("seq").alias("length")))
    found = regions.filter(F.col("region").isin(listed)).select("seqname", "seq")
    return top_rows(found, ["seqname"], [F.col("seq").desc()]).select(
        "seqname", "seq", F.length("seq").alias("length"))


def run_stratify(spark: SparkSession, run: RunConfig) -> DataFrame:
    """Writes tiered sequences and lengths; returns the tier counts with their total."""
    tiered = stratify.assign_tiers(read_sequences(spark, run), "length",
                                   run.tier_bounds, run.tier_shuffles)
    sinks.write_tiers(tiered, f"{run.tier_root}/tiers")
    written = spark.read.parquet(f"{run.tier_root}/tiers")
    sinks.write_lengths(written, f"{run.tier_root}/lengths.tsv")
    orphans = stratify.orphan_sequences(
        written.select("seqname"), tables.read_manifest(spark, run.manifest_tsv)).count()
    if orphans:
        log.warning("%d sequences are not in the manifest.", orphans)
    return stratify.with_total(stratify.tier_counts(written, run.tier_bounds))


def read_tiers(spark: SparkSession, run: RunConfig) -> DataFrame:
    tiered = read_if_exists(spark, f"{run.tier_root}/tiers")
    if tiered is None:
        raise FileNotFoundError(f"no tiers in {run.tier_root}; stratify first")
    return tiered


def run_calibrate(spark: SparkSession, run: RunConfig, scorer) -> DataFrame:
    """Times the longest sequences of each tier; returns the recommendations.

    Each run gets its own folder, and ``latest`` names the newest.
    """
    tiered = read_tiers(spark, run)
    longest = stratify.longest_per_tier(tiered.select("tier", "seqname", "length"),
                                        run.samples_per_tier)
    samples = having_key(tiered, longest, ["tier", "seqname"])
    run_id = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    folder = f"{run.calibration_root}/{run_id}"
    timed = calibrate.per_sample(scoring.time_samples(samples, scorer, run.seed))
    timed.write.parquet(f"{folder}/stage")
    timed = spark.read.parquet(f"{folder}/stage")
    advice = calibrate.recommend(timed, run.safety_factor_time, run.safety_factor_mem)
    sinks.write_table(timed, f"{folder}/per_sample.tsv", crlf=False)
    sinks.write_table(advice, f"{folder}/recommendations.tsv", crlf=False)
    sinks.write_lines(advice, [run_id], f"{run.calibration_root}/latest")
    return advice.orderBy("tier")


def latest_recommendations(spark: SparkSession, run: RunConfig) -> DataFrame:
    run_id = spark.read.text(f"{run.calibration_root}/latest").first().value
    return tables.read_recommendations(
        spark, f"{run.calibration_root}/{run_id}/recommendations.tsv")


def read_finished(spark: SparkSession, run: RunConfig, path: str) -> DataFrame | None:
    """A table of results, errors or raw shuffles, without the rows of batches that were stopped.

    A table that no batch has written, such as one made by hand, is read as it is.
    """
    rows = read_if_exists(spark, path)
    if rows is None or "batch" not in rows.columns:
        return rows
    marks = read_if_exists(spark, f"{run.results_dir}_finished")
    if marks is None:
        return rows.limit(0).drop("batch")
    return having_key(rows, marks, ["batch"]).drop("batch")


def read_done(spark: SparkSession, run: RunConfig, retry_failed: bool = True,
              result_files: str | None = None) -> DataFrame:
    """Names that have a result, or that failed when failures are not retried.

    ``result_files`` is a folder of published result files, one per sequence, that count too.
    """
    scored = read_finished(spark, run, run.results_dir)
    failed = None if retry_failed else read_finished(spark, run, run.errors_dir)
    if scored is None:
        scored = spark.createDataFrame([], "seq_name string")
    done = resume.completed(scored, failed)
    if result_files:
        files = read_whole_files(spark, result_files, "results_*.csv")
        done = done.unionByName(resume.completed_files(files))
    return done


def read_names(spark: SparkSession, path: str) -> DataFrame:
    """``seqname`` per line of a list; a line is a name or the path of a sequence file."""
    name = file_key(F.trim(F.regexp_replace("value", r"[\r\n]", "")), ".fa")
    return spark.read.text(path).select(name.alias("seqname")).filter("seqname <> ''").distinct()


def find_missing(spark: SparkSession, run: RunConfig, tiers: Iterable[int] | None = None,
                 retry_failed: bool = True, names: DataFrame | None = None,
                 result_files: str | None = None) -> DataFrame:
    """Sequences without a result, of all tiers, of ``tiers`` or of ``names``."""
    tiered = read_tiers(spark, run)
    if names is not None:
        unknown = lacking_key(names, tiered, ["seqname"]).count()
        if unknown:
            log.warning("%d listed names match no sequence.", unknown)
        tiered = having_key(tiered, names, ["seqname"])
    return resume.unfinished(tiered, read_done(spark, run, retry_failed, result_files), tiers)


def plan_submission(spark: SparkSession, run: RunConfig,
                    names: DataFrame | None = None) -> DataFrame:
    """What would be run: an explicit list of names, or all calibrated tiers."""
    tiered = read_tiers(spark, run)
    if names is not None:
        return submit.list_plan(having_key(tiered, names, ["seqname"]), run.n_shuffles,
                                run.slurm_time, run.slurm_mem_per_cpu, run.concurrent_limit)
    return submit.tier_plan(tiered, latest_recommendations(spark, run), run.concurrent_limit)


def run_scoring(spark: SparkSession, run: RunConfig, scorer, names: DataFrame | None = None,
                tiers: Iterable[int] | None = None, n_shuffles: int | None = None,
                retry_failed: bool = True, tasks: int | None = None,
                result_files: str | None = None,
                batch_sequences: int = BATCH_SEQUENCES) -> DataFrame:
    """Scores the unfinished sequences; returns their scores and errors.

    The work is cut into batches of about ``batch_sequences``. The list of what is to do is stored once,
    partitioned by batch, so a batch reads its own sequences only. A batch is written under its own
    name, over what a failed attempt has left there, and marked as finished last. A run
    that is stopped leaves at most one batch without a mark, which no reader looks at; the
    next run does its sequences again, and only those. ``remove_unfinished`` takes such batches away.
    """
    if not scorer.available():
        raise RuntimeError(f"{scorer} is not available here")
    todo = find_missing(spark, run, tiers, retry_failed, names, result_files)
    if n_shuffles is not None:
        todo = todo.withColumn("n_shuffles", F.lit(n_shuffles))
    run_name = uuid.uuid4().hex
    number, stage = store_todo(run, todo, run_name, batch_sequences)
    profiles = resources.tier_profiles(spark, _recommended(spark, run)) if resources.supported(spark) else {}
    done = [_score_batch(spark, run, scorer, read_batch(spark, stage, n), f"{run_name}_{n}", tasks, profiles)
            for n in range(number)]
    return spark.read.parquet(*done)


def _recommended(spark: SparkSession, run: RunConfig) -> list:
    """The recommendations of the last calibration, at most one row per tier; none without one."""
    if not folder_exists(spark, f"{run.calibration_root}/latest"):
        log.warning("Not calibrated, so all tiers share the session's resources.")
        return []
    return latest_recommendations(spark, run).collect()


# Tasks that write one batch of the list.
BATCH_FILES = 8


def store_todo(run: RunConfig, todo: DataFrame, run_name: str, batch_sequences: int) -> tuple[int, str]:
    """Writes the list of what is to do, which must not change as batches are finished. Returns
    the number of its batches and its path."""
    stage = f"{run.raw_shuffles_dir}_folds/todo={run_name}"
    number = max(1, -(-todo.count() // batch_sequences))
    mark = F.xxhash64("seqname")
    (todo.select("seqname", "seq", "length", "n_shuffles", "tier", F.pmod(mark, F.lit(number)).alias("batch"))
     .repartition(number * BATCH_FILES, "batch", F.pmod(F.shiftright(mark, 32), F.lit(BATCH_FILES)))
     .write.partitionBy("batch").parquet(stage))
    return number, stage


def read_batch(spark: SparkSession, stage: str, batch: int) -> DataFrame:
    """The sequences of one batch; the other partitions are not read."""
    schema = "seqname string, seq string, length int, n_shuffles int, tier int, batch bigint"
    return spark.read.schema(schema).parquet(stage).filter(F.col("batch") == batch).drop("batch")


def _write_batch(rows: DataFrame, path: str, name: str) -> None:
    """Puts the rows of one batch in the place of what it had; other batches stay as they are."""
    (rows.withColumn("batch", F.lit(name)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path))


def _score_batch(spark: SparkSession, run: RunConfig, scorer, todo: DataFrame, name: str,
                 tasks: int | None, profiles: dict) -> str:
    """Folds, reduces and commits one batch; returns the path of its scores."""
    batch = f"{run.raw_shuffles_dir}_folds/batch={name}"
    scoring.fold_by_tier(todo, scorer, profiles, run.seed, tasks).write.mode("overwrite").parquet(batch)
    folds = spark.read.parquet(batch)
    scoring.score_folds(folds, run.min_valid_percent).write.mode("overwrite").parquet(f"{batch}_scores")
    scored = spark.read.parquet(f"{batch}_scores")
    good = scoring.results(scored)
    own = having_key(folds, good.withColumnRenamed("seq_name", "seqname"), ["seqname"])
    _write_batch(scoring.raw_shuffles(own), run.raw_shuffles_dir, name)
    _write_batch(scoring.errors(scored), run.errors_dir, name)
    _write_batch(good, run.results_dir, name)
    spark.range(1).select(F.lit(name).alias("batch")).write.mode("append").parquet(
        f"{run.results_dir}_finished")
    return f"{batch}_scores"


def remove_unfinished(spark: SparkSession, run: RunConfig) -> list[str]:
    """Deletes results, raw shuffles and errors of batches without a mark, and returns their names.

    Only stopped runs leave such batches, but a run that still scores has one too: not to be called
    meanwhile. Tables without batches are left alone.
    """
    marks = read_if_exists(spark, f"{run.results_dir}_finished")
    removed: set[str] = set()
    for path in (run.results_dir, run.raw_shuffles_dir, run.errors_dir):
        rows = read_if_exists(spark, path)
        if rows is None or "batch" not in rows.columns:
            continue
        named = rows.select("batch").distinct()
        # A name per stopped run.
        names = [r.batch for r in (named if marks is None else lacking_key(named, marks, ["batch"])).collect()]
        for name in names:
            remove_folder(spark, f"{path}/batch={name}")
        removed |= set(names)
    return sorted(removed)


def export_text(spark: SparkSession, run: RunConfig, out: str) -> None:
    """Results and raw shuffles as published: comma-separated text with ``NA`` and four decimals."""
    scored = read_finished(spark, run, run.results_dir)
    if scored is None:
        raise FileNotFoundError(f"no results in {run.results_dir}")
    sinks.write_results(scored, f"{out}/results")
    raw = read_finished(spark, run, run.raw_shuffles_dir)
    if raw is not None:
        sinks.write_raw_shuffles(raw, f"{out}/raw_shuffles")
