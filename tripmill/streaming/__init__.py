"""Structured Streaming jobs over ride events."""
