"""Structured Streaming: event landing and continuous contract runs."""
