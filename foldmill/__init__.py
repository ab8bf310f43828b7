"""Transcript-region extraction and folding-stability scoring as Spark DataFrame jobs."""

__version__ = "0.1.0"
