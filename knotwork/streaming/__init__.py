"""Linkage of records that arrive in micro-batches."""
