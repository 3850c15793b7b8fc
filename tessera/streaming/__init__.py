"""Streaming entry points. The reference has no streams; only batched collection ingestion lives here."""
