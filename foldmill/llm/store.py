"""Tables written to the shared folder, so that they outlive executors."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window, functions as F

from foldmill.session import settle, shared_dir

__all__ = ["bucketed_texts", "narrow", "settle", "shuffle_partitions"]

# Parts of one id are told apart by this factor; no text has as many symbols.
PART = 1 << 40


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def bucketed_texts(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``doc_id, part, text`` of the rows with an id, written once in buckets of ``doc_id``.

    Later joins on ``doc_id`` shuffle the small side only, never the texts again.
    Rows that share an id are its parts, in order of their text's hash and then the text.
    With ``carry`` all other columns come along in the struct ``rest``.
    """
    spark = docs.sparkSession
    name = f"texts_{uuid.uuid4().hex}"
    order = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), F.col("text"))
    (narrow(docs, carry).filter("doc_id is not null")
     .withColumn("part", (F.row_number().over(order) - 1).cast("long"))
     .write.format("parquet").option("compression", "zstd")
     .option("path", f"{shared_dir(spark).rstrip('/')}/foldmill/{name}")
     .bucketBy(shuffle_partitions(docs), "doc_id").saveAsTable(name))
    return spark.table(name)


def narrow(docs: DataFrame, carry: bool = False) -> DataFrame:
    """``doc_id, text``, and with ``carry`` the other columns in the struct ``rest``."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rest = [F.struct(*others).alias("rest")] if carry and others else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *rest)
