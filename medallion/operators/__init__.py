"""Operators that take column names and rules: dedup, quality, lookup, numbering, checks."""
