"""Registered queries: every operator run over the driver tables, with its SQL twin."""

from __future__ import annotations

from tallyloom.catalog import aggregates, composite, registry, relational, scalars, series, sources, windows

__all__ = [
    "aggregates", "composite", "registry", "relational", "scalars", "series", "sources", "windows",
]
