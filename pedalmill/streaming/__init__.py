"""Incremental file ingest."""
