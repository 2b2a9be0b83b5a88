"""Structured Streaming ingest of deal files."""
