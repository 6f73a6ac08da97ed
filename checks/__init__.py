"""Checked queries: Spark views of the given tables and their SQL oracles."""
