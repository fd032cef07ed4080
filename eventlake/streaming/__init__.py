"""Curation of record streams."""
