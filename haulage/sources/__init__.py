"""Schemas, landing files, catalog tables and the mapping of the sample star schema."""
