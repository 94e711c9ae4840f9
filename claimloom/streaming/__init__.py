"""Arrival-driven jobs on Structured Streaming."""
