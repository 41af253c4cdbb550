"""Relational operators: all are DataFrame joins, windows and aggregations."""
