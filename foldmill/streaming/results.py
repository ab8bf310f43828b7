"""Collating result files while scoring is still writing them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from foldmill.fixed_values import RESULT_SCHEMA
from foldmill.operators.collate import collate_results
from foldmill.session import settle


def result_stream(spark: SparkSession, results_dir: str) -> DataFrame:
    """New result files of a folder as a stream; each file is read once."""
    return (spark.readStream.schema(RESULT_SCHEMA)
            .options(header=True, enforceSchema=False, nullValue="NA",
                     pathGlobFilter="results_*.csv")
            .csv(results_dir))


def collate_stream(spark: SparkSession, results_dir: str, manifest: DataFrame | None,
                   out: str, checkpoint: str) -> StreamingQuery:
    """Appends collated rows to the Parquet table ``out`` until all files are read.

    The same join as the batch step; a restart goes on after the last batch. The
    manifest is stored first, so a batch does not parse it again.
    """
    metadata = settle(manifest) if manifest is not None else None
    combined = collate_results(result_stream(spark, results_dir), metadata)
    return (combined.writeStream.outputMode("append").trigger(availableNow=True)
            .option("checkpointLocation", checkpoint).format("parquet").start(out))
