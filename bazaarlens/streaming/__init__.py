"""Incremental ingest of new captures."""
