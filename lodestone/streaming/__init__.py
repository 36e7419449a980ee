"""Structured Streaming: triggered ingestion, event producers and consumers."""
