"""Arrival-driven runs with Structured Streaming."""
