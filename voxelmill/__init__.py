"""Chunked, multi-resolution volumes as Spark DataFrames."""
