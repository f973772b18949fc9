"""Operators Spark has no single function for, composed from DataFrame steps."""
