"""Readers, form extraction, parameter tables and the report sink."""
