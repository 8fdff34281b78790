"""Structured Streaming over growing folders of events."""
