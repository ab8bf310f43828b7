"""Combined tables of results and shuffles."""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from foldmill.config import RunConfig
from foldmill.operators import collate
from foldmill.plans.score import read_finished
from foldmill.sources import sinks, tables

log = logging.getLogger(__name__)


def run_collate(spark: SparkSession, results_dir: str, manifest: str, out_dir: str,
                raw_dir: str | None = None, text_results: bool = False) -> DataFrame:
    """Writes the combined tables and returns the combined results.

    ``text_results`` reads result files written one per sequence, whose rows keep the order of
    the files' names and of the lines in them; further columns of the files go along. Otherwise the finished batches of
    the scoring step are read and rows are written in the order of their sequence names. ``raw_dir``
    adds the shuffles.
    """
    metadata = _manifest_or_none(spark, manifest)
    order = ["pos"] if text_results else ["seqname"]
    results = (tables.read_results(spark, results_dir, standard=False, placed=True) if text_results
               else _finished(spark, results_dir, results_dir))
    if results is None:
        raise FileNotFoundError(f"no results in {results_dir}")
    combined = collate.collate_results(results, metadata)
    rows = sinks.write_collated(combined, f"{out_dir}/combined_rnafold.tsv", order, drop=["pos"])
    log.info("%d combined results.", rows)
    if raw_dir:
        raw = (tables.read_raw_shuffles(spark, raw_dir, placed=True) if text_results
               else _finished(spark, raw_dir, results_dir))
        if raw is None:
            log.error("No raw shuffles in %s", raw_dir)
        else:
            rows = sinks.write_collated(
                collate.collate_raw(raw, metadata, carry=order if text_results else ()),
                f"{out_dir}/combined_rnafold_raw_shuffles.tsv",
                order if text_results else ["seqname", "iteration"], drop=["pos"])
            log.info("%d combined shuffles.", rows)
    return combined.drop("pos")


def _finished(spark: SparkSession, path: str, results_dir: str) -> DataFrame | None:
    return read_finished(spark, RunConfig(results_dir=results_dir), path)


def _manifest_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return tables.read_manifest(spark, path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        log.warning("No manifest at %s, so results are combined without their genes.", path)
        return None
