"""Reusable DataFrame operators: ordering, dedup, pair joins, metrics, quality checks."""
