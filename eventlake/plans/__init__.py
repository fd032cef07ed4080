"""Registered queries: the operators applied to the given tables, and the composed curation plan."""
