"""Structured Streaming forms of the ingest, upsert and sampling operators."""
