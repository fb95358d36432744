"""Granary: corpus building, deduplication and vocabulary work on Spark DataFrames."""

__version__ = "0.1.0"
