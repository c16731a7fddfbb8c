"""Readers, envelope construction, routing and sinks."""
