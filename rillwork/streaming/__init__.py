"""Sinks, per-batch lookups and keyed state for Structured Streaming."""
