"""Filings analytics and data processing expressed as Spark DataFrame plans."""
