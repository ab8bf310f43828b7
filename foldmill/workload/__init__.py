"""Queries over the driver tables, each with the SQL that gives the same rows."""

from foldmill.workload import annotation, collation, regions, scores, sequences, tiers
from foldmill.workload.registry import oracle_sql, queries

__all__ = ["annotation", "collation", "regions", "scores", "sequences", "tiers",
           "oracle_sql", "queries"]
