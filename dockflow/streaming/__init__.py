"""Structured Streaming jobs for hourly ingest, health and refresh."""
