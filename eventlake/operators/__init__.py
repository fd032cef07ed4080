"""Operators from DataFrame to DataFrame: extraction, normalization, rules, reshaping, lookup and validation."""
