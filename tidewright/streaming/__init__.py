"""Cursor streams as Structured Streaming queries."""
