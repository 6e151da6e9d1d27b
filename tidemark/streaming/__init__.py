"""Incremental ingest of arriving files, and rows that arrive late."""
