"""Operators for preparing training data: deduplication, formatting, scoring, search, packing."""
