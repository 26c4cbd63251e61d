"""Operators for preparing training text: secrets, near and exact duplicates, boilerplate lines,
toxicity, personal data, sharding, decontamination, packing and repeated passages.

Nothing outside this package imports it."""
