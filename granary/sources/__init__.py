"""Readers for landing files, table snapshots and the sample tables."""
