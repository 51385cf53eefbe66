"""Readers and writers of record, truth and result files."""
