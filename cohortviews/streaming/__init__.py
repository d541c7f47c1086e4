"""Resumable ingest as a Structured Streaming job."""
