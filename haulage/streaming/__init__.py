"""Incremental file streams: bronze ingest, silver transforms, live state."""
