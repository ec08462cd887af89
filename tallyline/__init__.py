"""Retail transaction analytics expressed as PySpark DataFrame plans."""
