"""Freight and logistics analytics on plain PySpark: every function takes and returns DataFrames."""

__version__ = "0.1.0"
