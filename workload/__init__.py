"""Queries over the given test tables, and the same in SQL."""
