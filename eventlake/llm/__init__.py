"""Operators for large training corpora: cleaning, deduplication, classification, packing and search.

Nothing outside this subpackage imports it.
"""
