"""Operators for large text corpora: one module per operator, queries and SQL in ``queries``."""
