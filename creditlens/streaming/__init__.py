"""Structured Streaming jobs (watermarked windowed monitoring)."""
