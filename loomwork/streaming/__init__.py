"""Structured Streaming jobs: log ingest, state changes, status upserts, live roll-up, loss windows."""
