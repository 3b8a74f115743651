"""Structured Streaming jobs. Each takes a streaming DataFrame and starts a query."""
