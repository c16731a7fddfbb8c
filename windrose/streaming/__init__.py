"""Structured Streaming forms of the window, state and metrics operators."""
