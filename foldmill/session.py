"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A row that goes to Python may hold a whole sequence, so batches stay short.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "256",
}


def builder(app_name: str = "foldmill"):
    """A session builder with the settings this package is written for.

    Master, memory and shuffle partitions are left to the cluster's own settings.
    """
    session_builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        session_builder = session_builder.config(key, value)
    return session_builder


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A temporary folder is used only in local mode, where one machine runs
    everything; elsewhere a missing setting is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="foldmill-"))
    return spark.sparkContext.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Writes ``df`` as a table in the shared folder and reads it back.

    Cuts lineage like a checkpoint: the rows are computed once, survive the loss of
    executors, and are the same for every later read. Later reads fetch only the
    columns they use.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/foldmill/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _store(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def folder_exists(spark: SparkSession, path: str) -> bool:
    store, place = _store(spark, path)
    return store.exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store its path names."""
    store, place = _store(spark, path)
    store.delete(place, True)
