"""Composite measures: episodes, populations, reconciliation, series, report."""
