"""Delimited text whose files each have a header of their own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from foldmill.operators.keys import measured
from foldmill.sources.text import place_in_file

QUOTING = {"quote": '"', "escape": '"'}


def read_headed(spark: SparkSession, path: str, schema: str, extra: bool = False, pattern: str | None = None,
                sep: str = ",", null: str = "") -> DataFrame | None:
    """Rows of all files under ``path``, each file read by its own header; None where no file has
    a line. See :func:`by_header`."""
    reader = spark.read if pattern is None else spark.read.option("pathGlobFilter", pattern)
    lines = reader.text(path).select("value", place_in_file().alias("pos"))
    return by_header(lines, schema, extra, sep, null)


def by_header(lines: DataFrame, schema: str, extra: bool = False, sep: str = ",",
              null: str = "") -> DataFrame | None:
    """The rows of delimited ``lines`` with the columns of ``schema`` and ``pos``, or None without lines.

    ``lines`` has ``value`` and ``pos``, a struct that begins with ``file`` and sorts the lines of a
    file. The first line of every file is its header. Columns are found by name, so files may
    differ in their columns and in the order of these; a column that a file lacks is null there. With
    ``extra``, the further columns of all files follow as text, in order of first appearance. Rows
    with fewer fields than their header end in nulls, surplus fields are dropped. Empty lines, ``null``
    fields and fields that are not of their column's type count for nothing.

    Headers are found by one partial aggregation, a row per file leaves each task. Lines then
    learn where their file has each column, from a table of one row per file, which is broadcast
    if it is small; each line is parsed once, and nothing is gathered by file.
    """
    lines = lines.filter("value <> ''")
    names = [field.split()[0] for field in schema.split(", ")]
    kinds = [field.split()[1] for field in schema.split(", ")]
    heads = measured(lines.groupBy("pos.file").agg(F.min("pos").alias("first"),
                                                   F.min_by("value", "pos").alias("header")))
    # No header has more fields than separators and one.
    width = heads.agg(F.max(F.length("header") - F.length(F.replace("header", F.lit(sep))) + 1)).first()[0]
    if width is None:
        return None

    def fields(text: Column) -> Column:
        parsed = F.from_csv(text, ", ".join(f"_{n} STRING" for n in range(width)), {"sep": sep, "mode": "PERMISSIVE", **QUOTING})
        return F.array(*(parsed[f"_{n}"] for n in range(width)))

    heads = heads.withColumn("header", fields(F.col("header")))
    more = _further(heads, names) if extra else []
    places = heads.select(F.col("file").alias("_file"), "first", *(
        F.array_position("header", F.lit(name)).cast("int").alias(f"_at_{n}") for n, name in enumerate(names + more)))
    rows = lines.join(places, F.col("pos.file") == F.col("_file")).filter(F.col("pos") > F.col("first"))
    rows = rows.select("pos", fields(F.col("value")).alias("_fields"), *(f"_at_{n}" for n in range(len(names + more))))

    def found(n: int) -> Column:
        value = F.get("_fields", F.col(f"_at_{n}") - 1)
        return F.when(value != null, value)

    return rows.select(
        *(found(n).try_cast(kind).alias(name) for n, (name, kind) in enumerate(zip(names, kinds))),
        *(found(len(names) + n).alias(name) for n, name in enumerate(more)), "pos")


def _further(heads: DataFrame, names: list[str]) -> list[str]:
    """Names of the headers beyond ``names``: as many as a table has columns."""
    listed = heads.select("file", F.posexplode("header").alias("place", "name")).filter(F.col("name") != "")
    listed = reduce(lambda df, name: df.filter(F.col("name") != name), names, listed)
    first = listed.groupBy("name").agg(F.min(F.struct("file", "place")).alias("first"))
    return [row["name"] for row in first.orderBy("first").collect()]
