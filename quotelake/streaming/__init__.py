"""Structured Streaming: incremental loads of landing folders and running metrics."""
