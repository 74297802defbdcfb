"""Incremental variants of the batch steps."""
