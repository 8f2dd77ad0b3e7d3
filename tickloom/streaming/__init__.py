"""Structured Streaming: event-time windows and the micro-batch processor."""
