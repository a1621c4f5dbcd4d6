"""Queries over the generated test tables, and SQL twins to compare them with."""
