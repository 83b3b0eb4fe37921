"""Structured Streaming sources, event-time aggregates, sinks and continuous change apply."""
