"""Retail lakehouse jobs written as Spark DataFrame, SQL and Structured Streaming plans."""
