"""Conversions from raw acquisitions to multi-resolution volumes."""
