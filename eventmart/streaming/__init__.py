"""Structured Streaming jobs: file ingestion, deduplication, hourly activity, quarantine."""
