"""Structured Streaming runners and keyed state."""
