"""What a run was made from, and whether it is still current."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from foldmill.config import ExtractConfig
from foldmill.sources.sinks import write_lines


def read_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as problem:
        if "PATH_NOT_FOUND" in str(problem) or "UNABLE_TO_INFER_SCHEMA" in str(problem):
            return None
        raise


def fingerprint(spark: SparkSession, config: ExtractConfig) -> str:
    """Digest of the settings and of the inputs' names, sizes and times.

    The files are listed, not read.
    """
    digest = hashlib.sha256(json.dumps(asdict(config), sort_keys=True).encode())
    for path in (config.genome_fasta, config.annotation_gff, config.gene_list):
        listed = (spark.read.format("binaryFile").load(path)
                  .agg(F.count("*"), F.sum("length"), F.max(F.unix_micros("modificationTime")))
                  .first())
        digest.update(repr((path, *listed)).encode())
    return digest.hexdigest()


def read_run_manifest(spark: SparkSession, path: str) -> dict:
    try:
        lines = [row.value for row in spark.read.text(path).collect()]
        return json.loads("\n".join(lines))
    except (AnalysisException, ValueError):
        return {}


def is_current(spark: SparkSession, config: ExtractConfig, mark: str) -> bool:
    """Whether the outputs exist and were made from the same inputs and settings."""
    out = config.output_dir
    if read_run_manifest(spark, f"{out}/run_manifest.yaml").get("fingerprint") != mark:
        return False
    wanted = [f"{out}/manifest.tsv"]
    if config.output_mode == "multifasta":
        wanted += [f"{out}/fasta/region={r}" for r in config.regions_to_extract]
    try:
        for path in wanted:
            spark.read.text(path)
    except AnalysisException:
        return False
    return True


def write_run_manifest(spark: SparkSession, config: ExtractConfig, n_genes: int,
                       mark: str) -> None:
    """Run metadata as JSON, which is YAML too, one key per line."""
    import sys

    content = {
        "run_timestamp": datetime.now(timezone.utc).isoformat(),
        "python_executable": sys.executable,
        "n_requested_genes": n_genes,
        "isoform_priority_tags": list(config.isoform_priority),
        "fingerprint": mark,
        **{k: v for k, v in asdict(config).items() if k not in ("isoform_priority", "output_dir")},
    }
    text = json.dumps(content, indent=2, sort_keys=True)
    write_lines(spark.range(1), text.split("\n"), f"{config.output_dir}/run_manifest.yaml")
