"""Structured Streaming sinks and pipeline wiring."""
