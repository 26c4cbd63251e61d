"""Readers of image formats as Spark data sources."""
