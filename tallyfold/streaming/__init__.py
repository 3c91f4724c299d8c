"""Structured Streaming: sources, sinks, running and windowed aggregates."""
