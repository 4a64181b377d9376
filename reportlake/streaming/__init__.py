"""Incremental ingest as a checkpointed Structured Streaming file source."""
