"""Compliance auditing of corporate filings as Spark DataFrame plans."""
