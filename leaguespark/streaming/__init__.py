"""Streams over captures and requests: incremental loads, idempotent ingestion, rate limits, deliveries, cooldowns."""
