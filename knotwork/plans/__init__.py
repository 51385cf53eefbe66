"""Whole linkage runs, and the queries that the driver calls."""
