"""Structured Streaming forms of the file ingest and the upsert."""
