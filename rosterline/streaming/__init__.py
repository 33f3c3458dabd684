"""Structured Streaming entry points."""
