"""Structured Streaming jobs: ingest, storage fan-out, retries, progress metrics."""
